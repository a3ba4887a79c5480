"""Training sets, scaling, splits, classifiers and their evaluation."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, RegexTokenizer, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliolens.operators.labels import LEVELS, TEXT_LEVELS, class_of, in_vocabulary, label_first, label_last, label_title
from foliolens.operators.boosting import SoftmaxBoosting
from foliolens.operators.labels import labelled, level_of
from foliolens.operators.network import FusedNetwork
from foliolens.operators.perceptron import Perceptron
from foliolens.plans.chunks import numbered
from foliolens.plans.lineage import cut, lookup_join
from foliolens.sources.files import outline_entries

# Feature columns of the three training sets, in order.
SPAN_FEATURES = ["font_size", "bold", "top", "spacing"]
LINE_FEATURES = [
    "font_size", "bold", "spacing_before", "spacing_after", "indent", "length", "is_upper", "line_top",
    "line_bottom", "ends_with_colon", "is_short", "is_numbered", "first_page", "page", "num_words", "num_verbs",
    "num_nouns", "num_adjectives", "num_adverbs", "num_pronouns", "num_cardinals", "num_conjunctions",
    "num_predeterminers", "num_interjections",
]
LAYOUT_FEATURES = ["font_size", "bold", "length", "is_upper", "indent", "spacing_before", "spacing_after"]


def span_training_set(
    spans: DataFrame, labels: DataFrame, page_base: int = 0, need_outline: bool = True, known_only: bool = True
) -> DataFrame:
    """Span features with the last matching label and its class; documents without labels are left out."""
    entries = outline_entries(labels)
    if known_only:
        entries = in_vocabulary(entries)
    rows = labelled(spans, labels, need_outline)
    return label_last(rows, entries, page_base).withColumn("class", class_of("label"))


def line_training_set(lines: DataFrame, labels: DataFrame) -> DataFrame:
    """Line features with the first matching label; lines whose label is outside the vocabulary are left out."""
    joined = label_first(labelled(lines, labels), outline_entries(labels))
    return joined.withColumn("class", class_of("label")).where(F.col("class").isNotNull())


def text_training_set(lines: DataFrame, labels: DataFrame) -> DataFrame:
    """Line text and layout with Title, heading or NotHeading."""
    joined = label_title(labelled(lines, labels), labels, outline_entries(labels))
    return joined.withColumn("class", class_of("label", TEXT_LEVELS))


def training_counts(examples: DataFrame, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Samples collected, headings among them, and documents skipped for want of labels."""
    kept = examples.agg(
        F.count(F.lit(1)).alias("samples"),
        F.count_if(F.col("label") != "BODY").alias("headings"),
    )
    skipped = documents.join(labels.select("doc_id"), "doc_id", "left_anti").agg(F.count(F.lit(1)).alias("skipped"))
    counters = [
        kept.select(F.lit(name).alias("counter"), F.col(name).alias("n")) for name in ("samples", "headings")
    ]
    return counters[0].unionByName(counters[1]).unionByName(
        skipped.select(F.lit("skipped documents").alias("counter"), F.col("skipped").alias("n"))
    )


def filled(rows: DataFrame, names: list[str]) -> DataFrame:
    """Feature columns as doubles, absent ones and nulls as 0."""
    present = set(rows.columns)
    values = {n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in present else F.lit(0.0) for n in names}
    return rows.withColumns(values)


class Scaling:
    """Mean 0 and population deviation 1 per column; a constant column is only centred."""

    def __init__(self, rows: DataFrame, names: list[str]):
        self.names = names
        moments = [f(F.col(n).cast("double")).alias(f"{p}{i}") for i, n in enumerate(names) for f, p in ((F.avg, "m"), (F.stddev_pop, "s"))]
        row = rows.agg(*moments).first()
        self.means = [row[f"m{i}"] or 0.0 for i in range(len(names))]
        deviations = [row[f"s{i}"] for i in range(len(names))]
        self.deviations = [s if s and s > 1e-12 else 1.0 for s in deviations]

    def columns(self) -> dict[str, Column]:
        return {
            n: (F.col(n).cast("double") - F.lit(m)) / F.lit(s)
            for n, m, s in zip(self.names, self.means, self.deviations)
        }

    def transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns(self.columns())


class SplitKey:
    """A place for each row that depends on its key columns alone: the first 32 bits of an MD5 digest."""

    @staticmethod
    def of(*keys: str, seed: int = 42) -> Column:
        text = F.concat_ws("-", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def split(rows: DataFrame, keys: list[str], share: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds part: train or test, by the row's key alone, so it holds for any layout of the data."""
    in_train = SplitKey.of(*keys, seed=seed) % 1000 < round(share * 1000)
    return rows.withColumn("part", F.when(in_train, "train").otherwise("test"))


#: Low bits of a hash that the first counts leave out, so that both counts have at most 65,536 rows per label.
LOW_BITS = 16


def split_stratified(rows: DataFrame, keys: list[str], label: str = "label", share: float = 0.8, seed: int = 42) -> DataFrame:
    """Adds part with exactly floor(share * n) train rows of every label, those first by hash, then by keys.

    The hash of the last train row is found from counts by its upper, then its lower half, so no task ever sorts the rows of a label.  Rows
    that share that hash are told apart by their keys; only where the border runs through rows of equal keys are those numbered.  A null
    label is a label, too.
    """
    group = F.to_json(F.struct(F.col(label).alias("l")))
    placed = rows.withColumn("_hash", SplitKey.of(*keys, seed=seed)).withColumn("_group", group)
    placed = placed.withColumn("_key", F.struct(*[F.col(k) for k in keys]))
    known = cut(placed.select("_group", "_hash", "_key"))
    before = Window.partitionBy("_group").rowsBetween(Window.unboundedPreceding, -1)

    def border(counts: DataFrame, column: str) -> DataFrame:
        """The first value of a column, per group, with which the counts up to it reach the quota, and the quota that is left at it."""
        earlier = F.coalesce(F.sum("n").over(before.orderBy(column)), F.lit(0))
        reached = counts.withColumn("_before", earlier).where((F.col("_before") < F.col("quota")) & (F.col("_before") + F.col("n") >= F.col("quota")))
        return reached.select("_group", column, (F.col("quota") - F.col("_before")).alias("quota"), "n")

    high = F.shiftright("_hash", LOW_BITS).alias("high")
    upper = known.groupBy("_group", high).agg(F.count(F.lit(1)).alias("n"))
    quota = F.floor(F.sum("n").over(Window.partitionBy("_group")) * share)
    upper = border(upper.withColumn("quota", quota), "high").drop("n")

    def finer(found: DataFrame, column: str, match: str) -> DataFrame:
        """The border among the rows that share the border so far, by one more column."""
        inside = lookup_join(known.withColumn("high", F.shiftright("_hash", LOW_BITS)), found, ["_group", match], "inner", salt="_hash")
        return cut(border(inside.groupBy("_group", column, "quota").agg(F.count(F.lit(1)).alias("n")), column))

    last = finer(upper, "_hash", "high").drop("n")
    keyed = finer(last, "_key", "_hash").withColumnsRenamed({"_key": "_last_key", "quota": "_left", "n": "_equal"})
    ends = last.drop("quota").withColumnRenamed("_hash", "_last").join(keyed, "_group")
    marked = lookup_join(placed, ends, ["_group"], "left", salt="_hash")
    at_border = (F.col("_hash") == F.col("_last")) & (F.col("_key") == F.col("_last_key"))
    train = (F.col("_hash") < F.col("_last")) | ((F.col("_hash") == F.col("_last")) & (F.col("_key") < F.col("_last_key")))
    train = train | (at_border & (F.col("_left") == F.col("_equal")))
    columns = [*rows.columns, "part"]
    part = lambda inside: F.when(F.coalesce(inside, F.lit(False)), "train").otherwise("test")
    if ends.where("_left < _equal").isEmpty():
        return marked.withColumn("part", part(train)).select(*columns)
    between = F.coalesce(at_border & (F.col("_left") < F.col("_equal")), F.lit(False))
    alike = cut(marked.where(between)).withColumn("_id", F.monotonically_increasing_id()).withColumn("_chunk", F.shiftright("_id", 33))
    counted = numbered(alike, ["_group"], "_chunk", ["_id"], "_place").withColumn("part", part(F.col("_place") < F.col("_left")))
    return marked.where(~between).withColumn("part", part(train)).select(*columns).unionByName(counted.select(*columns))


def vector_stages(rows: DataFrame, names: list[str], scale: bool) -> list:
    """Assembler, and the fitted scaling as vector stages that are saved with the model."""
    assembled = "raw_features" if scale else "features"
    stages: list = [VectorAssembler(inputCols=names, outputCol=assembled, handleInvalid="keep")]
    if scale:
        scaling = Scaling(rows, names)
        stages += [
            StandardScaler(withMean=True, withStd=False, inputCol="raw_features", outputCol="centred"),
            ElementwiseProduct(
                scalingVec=Vectors.dense([1.0 / s for s in scaling.deviations]), inputCol="centred", outputCol="features"
            ),
        ]
    return stages


def fit(
    train: DataFrame, names: list[str], classifier: Estimator, scale: bool = False, scale_on: DataFrame | None = None
) -> PipelineModel:
    """Train on the rows of `train`; scaling, if any, is fitted on them too, or on `scale_on` (say, all rows)."""
    rows = filled(train, names).withColumn("class", F.col("class").cast("double"))
    basis = rows if scale_on is None else filled(scale_on, names)
    stages = Pipeline(stages=vector_stages(basis, names, scale)).fit(basis)
    model = Pipeline(stages=[classifier]).fit(stages.transform(rows))
    return PipelineModel([*stages.stages, *model.stages])


def random_forest(trees: int = 100, depth: int = 30, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="class", featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=1
    )


def boosted_trees(rounds: int = 100, depth: int = 6, rate: float = 0.1, seed: int = 42) -> OneVsRest:
    one = GBTClassifier(featuresCol="features", labelCol="class", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed)
    return OneVsRest(classifier=one, labelCol="class", featuresCol="features", parallelism=4)


def softmax_trees(rounds: int = 100, depth: int = 6, rate: float = 0.1, classes: int = 4) -> SoftmaxBoosting:
    """Boosting of one softmax over all classes: fewer passes and a lower loss than `boosted_trees`, a model per class against the rest."""
    return SoftmaxBoosting(rounds=rounds, depth=depth, rate=rate, classes=classes)


def perceptron(inputs: int, classes: int = 4, rounds: int = 300, seed: int = 42) -> Perceptron:
    return Perceptron(layers=[inputs, 32, 16, classes], rounds=rounds, seed=seed)


def text_layout_classifier(train: DataFrame, vocabulary: int = 1 << 18, rounds: int = 50) -> PipelineModel:
    """TF-IDF of the words of the text (the most frequent `vocabulary`) next to the scaled layout columns, into a multinomial classifier."""
    rows = filled(train, LAYOUT_FEATURES).withColumn("class", F.col("class").cast("double"))
    layout = vector_stages(rows, LAYOUT_FEATURES, scale=True)
    layout[-1].setOutputCol("layout")
    stages = [
        RegexTokenizer(inputCol="text", outputCol="words", pattern="[^\\p{L}\\p{N}_]+", minTokenLength=1),
        CountVectorizer(inputCol="words", outputCol="counts", vocabSize=vocabulary),
        IDF(inputCol="counts", outputCol="text_vector"),
        *layout,
        VectorAssembler(inputCols=["text_vector", "layout"], outputCol="features"),
        LogisticRegression(labelCol="class", featuresCol="features", maxIter=rounds, regParam=1e-2, standardization=False),
    ]
    return Pipeline(stages=stages).fit(rows)


def fused_classifier(train: DataFrame, **settings) -> PipelineModel:
    """Words of the text, none left out, next to the scaled layout columns, through a hidden layer into the classes."""
    rows = filled(train, LAYOUT_FEATURES).withColumn("class", F.col("class").cast("double"))
    layout = vector_stages(rows, LAYOUT_FEATURES, scale=True)
    layout[-1].setOutputCol("layout")
    words = RegexTokenizer(inputCol="text", outputCol="words", pattern="[^\\p{L}\\p{N}_]+", minTokenLength=1)
    network = FusedNetwork(classes=len(TEXT_LEVELS), **settings)
    return Pipeline(stages=[words, *layout, network]).fit(rows)


def score(rows: DataFrame, model: PipelineModel, names: list[str], vocabulary: dict[str, int] = LEVELS) -> DataFrame:
    """Adds the predicted level of every row in one pass."""
    inputs = filled(rows.select("*", *[F.col(n).alias(f"_kept_{n}") for n in names if n in rows.columns]), names)
    predicted = model.transform(inputs)
    restored = [F.col(f"_kept_{c}").alias(c) if c in names else F.col(c) for c in rows.columns]
    return predicted.select(*restored, level_of(F.col("prediction").cast("int"), vocabulary).alias("level"))


def save(model: PipelineModel, folder: str) -> None:
    model.write().overwrite().save(folder)


def load(folder: str) -> PipelineModel:
    return PipelineModel.load(folder)


def classification_report(predictions: DataFrame, label: str, predicted: str, classes: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages; x / 0 is 0.

    `classes` adds classes that never occur.  The confusion counts are the only shuffle; the rest is
    one row with an array of the classes.
    """
    confusion = predictions.groupBy(F.col(label).alias("_l"), F.col(predicted).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    hit = F.when(F.col("_l") == F.col("_p"), F.col("_n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("_l").alias("class"), hit.alias("hits"), F.lit(0).cast("long").alias("found"), F.col("_n").alias("support")),
        F.struct(F.col("_p").alias("class"), F.lit(0).cast("long").alias("hits"), F.col("_n").alias("found"), F.lit(0).cast("long").alias("support")),
    )
    rows = confusion.select(F.explode(sides).alias("s")).select("s.*")
    if classes:
        spark = predictions.sparkSession
        rows = rows.unionByName(spark.createDataFrame([(c, 0, 0, 0) for c in classes], "class string, hits long, found long, support long"))
    per_class = rows.groupBy("class").agg(F.sum("hits").alias("hits"), F.sum("found").alias("found"), F.sum("support").alias("support"))

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    def scored(c: Column) -> Column:
        precision, recall = ratio(c["hits"], c["found"]), ratio(c["hits"], c["support"])
        return F.struct(
            c["class"].alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            ratio(2 * precision * recall, precision + recall).alias("f1"),
            c["support"].alias("support"),
        )

    def total(items: Column | str, value) -> Column:
        return F.aggregate(items, F.lit(0.0), lambda t, c: t + value(c).cast("double"))

    gathered = per_class.agg(F.array_sort(F.collect_list(F.struct("class", "hits", "found", "support"))).alias("c"))
    scored_rows = gathered.select("c", F.transform("c", scored).alias("rows"), total("c", lambda c: c["support"]).alias("n"))
    accuracy = ratio(total("c", lambda c: c["hits"]), F.col("n"))

    def average(name: str, weighted: bool) -> Column:
        def mean(field: str) -> Column:
            if weighted:
                return ratio(total("rows", lambda r: r[field] * r["support"]), F.col("n"))
            return ratio(total("rows", lambda r: r[field]), F.size("rows").cast("double"))

        return F.struct(
            F.lit(name).alias("class"),
            mean("precision").alias("precision"),
            mean("recall").alias("recall"),
            mean("f1").alias("f1"),
            F.col("n").cast("long").alias("support"),
        )

    overall = F.struct(
        F.lit("accuracy").alias("class"),
        accuracy.alias("precision"),
        accuracy.alias("recall"),
        accuracy.alias("f1"),
        F.col("n").cast("long").alias("support"),
    )
    everything = F.concat("rows", F.array(overall, average("macro avg", False), average("weighted avg", True)))
    return scored_rows.select(F.explode(everything).alias("row")).select("row.*")
