"""Word classes by a hidden Markov model: counts by aggregation, the best tag sequence of each line by Viterbi decoding.

Training is three aggregations over a tagged corpus of any size.  The vocabulary is the only part of the model that grows with
the corpus; where it is too large to broadcast, words meet their counts in a join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliolens.functions.tagged import sentences
from foliolens.functions.text import LEXICON, WORD_PATTERN, tag_counts
from foliolens.plans.lineage import cut, fits_broadcast, salted_join
from foliolens.plans.shipping import by_value

EDGE = "<s>"
#: Words seen at most so often tell about unknown words by their endings, of at most this length.
RARE, LONGEST = 10, 4
#: Weight of the endings against the counts of a known word, and of each shorter ending against the next longer one.
OWN, SHORTER = 0.5, 2.0
#: Words decoded together.
BATCH_WORDS = 50_000
#: Sentences scored together, few enough for their paths to stay in a core's cache, and words of which all scores are kept.
TOGETHER, KEPT_WORDS = 32, 200_000
WORD = re.compile("[^\\W_]+")
VOCABULARY = "word string, tag string, n long"


def corpus(spark: SparkSession) -> DataFrame:
    """The corpus of the package: sentence, words, tags."""
    return spark.createDataFrame(sentences(), "sentence long, words array<string>, tags array<string>")


def shape(word: str, first: bool) -> str:
    """d with a digit, else C for a capital that does not open the sentence, else c."""
    return "d" if not word.isalpha() and any(c.isdigit() for c in word) else "C" if word[:1].isupper() and not first else "c"


def _shape(word, first):
    return F.when(word.rlike("\\p{Nd}"), "d").when(word.rlike("^\\p{Lu}") & ~first, "C").otherwise("c")


class Tagger:
    """Counts of a tagged corpus: word and tag (a table), tag after tag and ending and tag (bounded by tags and letters).

    P(tag | word) mixes the word's own counts with those of its endings; P(word | tag) follows from it by Bayes' rule.
    P(tag | previous) mixes pairs and single tags, by the share of pairs that other pairs would have foretold.
    """

    def __init__(self, vocabulary: DataFrame, pairs: list[tuple[str, str, int]], endings: list[tuple[str, str, str, int]]):
        self.vocabulary = vocabulary
        self.pairs, self.endings = sorted(pairs), sorted(endings)
        self.tags = sorted({t for _, t, _ in pairs if t != EDGE})

    @classmethod
    def fit(cls, tagged: DataFrame, lexicon: dict[str, list[str]] | None = LEXICON) -> Tagger:
        """`tagged` has words and tags, arrays of one length; sentences without words teach nothing.

        Words are looked up in lower case; a capital counts for endings, but not that of a sentence's first word.  Each word of
        the lexicon is counted once more for its tags; its closed classes say nothing about unknown words.
        """
        edge = F.array(F.lit(EDGE))
        follow = F.arrays_zip(F.concat(edge, "tags").alias("before"), F.concat("tags", edge).alias("tag"))
        pairs = tagged.where(F.size("words") > 0).select(F.explode(follow).alias("p")).groupBy("p.before", "p.tag").count()
        places = tagged.select(F.posexplode(F.arrays_zip("words", "tags")).alias("place", "w"))
        seen = places.select("place", F.col("w.words").alias("form"), F.col("w.tags").alias("tag"))
        lowered = seen.select(F.lower("form").alias("word"), _shape(F.col("form"), F.col("place") == 0).alias("shape"), "tag")
        counts = cut(lowered.groupBy("word", "shape", "tag").agg(F.count(F.lit(1)).alias("n")))
        listed = tagged.sparkSession.createDataFrame([(w, t, 1) for t, ws in (lexicon or {}).items() for w in ws], VOCABULARY)
        known = counts.select("word", "tag", "n").unionByName(listed)
        vocabulary = cut(known.groupBy("word", "tag").agg(F.sum("n").alias("n")))
        rare = counts.groupBy("word").agg(F.sum("n").alias("all")).where(F.col("all") <= RARE).select("word")
        lengths = F.sequence(F.lit(0), F.least(F.lit(LONGEST), F.char_length("word")))
        endings = (
            counts.join(rare, "word", "left_semi")
            .select("shape", "tag", "n", F.explode(F.transform(lengths, lambda k: F.substr("word", F.char_length("word") - k + 1, k))).alias("ending"))
            .groupBy("shape", "ending", "tag")
            .agg(F.sum("n").alias("n"))
        )
        return cls(vocabulary, [tuple(r) for r in pairs.collect()], [tuple(r) for r in endings.collect()])

    # --- The model as arrays -------------------------------------------------------------------------------------------------------

    def parts(self) -> dict:
        """What each task needs besides the vocabulary: log transitions and the tags' shares by shape and ending."""
        index = {t: i for i, t in enumerate(self.tags)}
        k = len(self.tags)
        table = np.zeros((k + 1, k + 1))  # the last row and column are the edge of a sentence
        for before, tag, n in self.pairs:
            table[index.get(before, k), index.get(tag, k)] += n
        single, total = table.sum(axis=0), table.sum()
        # Deleted interpolation: each pair votes for whatever foretells it best once it is left out.
        votes = [0.0, 0.0]
        for a, b in zip(*np.nonzero(table)):
            n, row = table[a, b], table[a].sum()
            of_pair = (n - 1) / (row - 1) if row > 1 else 0.0
            of_single = (single[b] - 1) / (total - 1) if total > 1 else 0.0
            votes[int(of_pair >= of_single)] += n
        share = votes[1] / max(sum(votes), 1)
        smooth = share * table / np.maximum(table.sum(axis=1, keepdims=True), 1) + (1 - share) * single / max(total, 1)
        smooth = np.log(smooth + 1e-12)
        prior = (single[:k] + 0.5) / (single[:k] + 0.5).sum()
        endings: dict[tuple[str, str], np.ndarray] = {}
        for kind, ending, tag, n in self.endings:
            endings.setdefault((kind, ending), np.zeros(k))[index[tag]] += n
        return {
            "tags": self.tags, "index": index, "first": smooth[k, :k], "follow": smooth[:k, :k], "last": smooth[:k, k], "prior": prior, "endings": endings,
        }

    # --- Tagging -------------------------------------------------------------------------------------------------------------------

    def tag(self, rows: DataFrame, text: str = "text", column: str = "tags") -> DataFrame:
        """Adds the tags of the words (runs of letters and digits) of each row's text, in order; null and empty texts have none.

        Each row is decoded as one sentence, whatever its length; the memory of a long one is one byte per word and tag.  Equal scores go to the
        tag that sorts first.
        """
        names = [c for c in rows.columns if c != column]
        kinds = [f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names]
        schema = ", ".join([*kinds, f"`{column}` array<string>"])
        model = self.parts()
        if fits_broadcast(self.vocabulary, rows=200_000):
            counts: dict[str, dict[str, int]] = {}
            for r in self.vocabulary.collect():
                counts.setdefault(r["word"], {})[r["tag"]] = r["n"]
            return rows.select(*names).mapInPandas(by_value(_decoder)(model, counts, text, column, None), schema)
        return self._tag_by_join(rows.select(*names), text, column, model, schema)

    def _tag_by_join(self, rows: DataFrame, text: str, column: str, model: dict, schema: str) -> DataFrame:
        """Distinct words of each row fetch their counts by a salted join and return to the row as one map."""
        keyed = cut(rows.withColumn("_row", F.monotonically_increasing_id()))
        words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_PATTERN), F.lit(1)))
        uses = keyed.select("_row", F.explode(words).alias("word"))
        known = self.vocabulary.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("tag", "n"))).alias("_counts"))
        found = salted_join(uses, known, ["word"], "inner", salt="_row")
        per_row = found.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("word", "_counts"))).alias("_known"))
        joined = keyed.join(per_row, "_row", "left").drop("_row")
        known_json = F.to_json(F.coalesce("_known", F.from_json(F.lit("{}"), "map<string,map<string,bigint>>")))
        return joined.withColumn("_known", known_json).mapInPandas(by_value(_decoder)(model, {}, text, column, "_known"), schema)

    def save(self, folder: str) -> None:
        """Three tables below the folder."""
        spark = self.vocabulary.sparkSession
        self.vocabulary.write.mode("overwrite").parquet(f"{folder}/vocabulary")
        spark.createDataFrame(self.pairs, "before string, tag string, n long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/pairs")
        endings = spark.createDataFrame(self.endings, "shape string, ending string, tag string, n long")
        endings.coalesce(1).write.mode("overwrite").parquet(f"{folder}/endings")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Tagger:
        pairs, endings = (spark.read.parquet(f"{folder}/{name}").collect() for name in ("pairs", "endings"))
        return cls(spark.read.schema(VOCABULARY).parquet(f"{folder}/vocabulary"), [tuple(r) for r in pairs], [tuple(r) for r in endings])


def of_ending(model: dict, word: str, kind: str) -> np.ndarray:
    """Share of each tag among rare words with the word's ending: longer endings are mixed with shorter ones."""
    share = model["prior"]
    for length in range(LONGEST + 1):
        if length > len(word):
            break
        counts = model["endings"].get((kind, word[len(word) - length :]))
        if counts is None:
            if length:
                break
            continue
        share = (counts + SHORTER * share) / (counts.sum() + SHORTER)
    return share


def emission(model: dict, counts: dict[str, int] | None, word: str, kind: str) -> np.ndarray:
    """Log of P(word | tag) up to a constant of the word."""
    share = of_ending(model, word, kind)
    if counts:
        own = np.zeros(len(model["tags"]))
        for tag, n in counts.items():
            if tag in model["index"]:
                own[model["index"][tag]] += n
        share = (own + OWN * share) / (own.sum() + OWN)
    return np.log(share + 1e-12) - np.log(model["prior"])


def viterbi(model: dict, lengths: list[int], words: np.ndarray, emissions: np.ndarray) -> list[np.ndarray]:
    """The best tags of sentences of the given lengths; `words` holds a row of `emissions` for each word, one sentence after the other.

    The scores of every word are kept, and only the way that was taken is followed back.  Words beyond `KEPT_WORDS`, in one long sentence,
    keep the best tag before each tag instead, in a byte.
    """
    order = np.argsort([-n for n in lengths], kind="stable")
    sizes = np.array(lengths)[order]
    starts = (np.cumsum(lengths) - lengths)[order]
    follow, wide = model["follow"], len(words) > KEPT_WORDS
    paths = np.empty((TOGETHER, *follow.shape))
    back: list[np.ndarray] = []
    score = model["first"] + emissions[words[starts]]
    ends = np.zeros((len(sizes), len(model["tags"])))
    for at in range(1, int(sizes[0]) + 1):
        alive = int(np.searchsorted(-sizes, -at, "left"))  # sentences longer than `at`
        ends[alive : len(score)] = score[alive:] + model["last"]
        if not alive:
            break
        if wide:
            best = (score[:alive, :, None] + follow).argmax(axis=1)
            back.append(best.astype(np.uint8 if len(model["tags"]) < 256 else np.uint16))
        else:
            back.append(score[:alive])
        now = emissions[words[starts[:alive] + at]]
        for first in range(0, alive, TOGETHER):
            some = score[first : min(first + TOGETHER, alive), :, None]
            now[first : first + TOGETHER] += np.add(some, follow, out=paths[: len(some)]).max(axis=1)
        score = now
    now = ends.argmax(axis=1)
    tags = np.zeros(len(words), np.int64)
    for at in range(int(sizes[0]) - 1, -1, -1):
        alive = int(np.searchsorted(-sizes, -at, "left"))
        tags[starts[:alive] + at] = now[:alive]
        if at and wide:
            now[:alive] = back[at - 1][np.arange(alive), now[:alive]]
        elif at:
            now[:alive] = (back[at - 1] + follow.T[now[:alive]]).argmax(axis=1)
    return np.split(tags, np.cumsum(lengths)[:-1])


class _Numbers(dict):
    """The number of the row of emissions of each word as it is written, in the opening of a sentence or inside."""

    def __init__(self, first: bool, add):
        super().__init__()
        self.first, self.add = first, add

    def __missing__(self, form: str) -> int:
        number = self[form] = self.add(form.lower(), shape(form, self.first))
        return number


class _Emissions:
    """Rows of emissions, made as words turn up: one for each known word and shape, and one for each ending and shape of all others."""

    def __init__(self, model: dict, counts: dict[str, dict[str, int]]):
        self.model, self.counts, self.rows, self.made = model, counts, [], {}
        self.table = np.zeros((0, len(model["tags"])))
        self.opening, self.inside = _Numbers(True, self.add), _Numbers(False, self.add)

    def add(self, word: str, kind: str) -> int:
        counts = self.counts.get(word)
        key = (word, kind, True) if counts else (word[-LONGEST:], kind, False)
        if key not in self.made:
            self.made[key] = len(self.rows)
            self.rows.append(emission(self.model, counts, word, kind))
        return self.made[key]

    def numbers(self, found: list[str]) -> list[int]:
        return [self.opening[found[0]], *map(self.inside.__getitem__, found[1:])]

    def all(self) -> np.ndarray:
        if len(self.table) < len(self.rows):
            self.table = np.concatenate([self.table, self.rows[len(self.table) :]])
        return self.table

    def full(self) -> bool:
        return len(self.opening) + len(self.inside) > 2 * BATCH_WORDS


def _decoder(model: dict, vocabulary: dict[str, dict[str, int]], text: str, column: str, known: str | None):
    """A function over pandas batches that adds the tags."""

    def decode(out: list, rows: list[int], lengths: list[int], places: list[int], table: np.ndarray) -> None:
        for row, tags in zip(rows, viterbi(model, lengths, np.array(places), table)):
            out[row] = np.array(model["tags"], object)[tags].tolist()

    def tag_texts(texts: list, local: list, words: list[_Emissions]) -> list[list[str]]:
        """`words` holds what is kept from batch to batch, until it has grown too large."""
        out: list[list[str]] = [[] for _ in texts]
        at = 0
        while at < len(texts):
            rows, lengths, places = [], [], []
            if not words or words[0].full():
                words[:] = [_Emissions(model, vocabulary)]
            while at < len(texts) and len(places) < BATCH_WORDS:
                found = WORD.findall(texts[at] or "")
                if found and known:
                    own = _Emissions(model, local[at])
                    decode(out, [at], [len(found)], own.numbers(found), own.all())
                elif found:
                    places += words[0].numbers(found)
                    rows.append(at)
                    lengths.append(len(found))
                at += 1
            if rows:
                decode(out, rows, lengths, places, words[0].all())
        return out

    def run(batches: Iterator) -> Iterator:
        import json

        words: list[_Emissions] = []
        for batch in batches:
            local = [json.loads(x) for x in batch[known]] if known else []
            yield batch.drop(columns=[known] if known else []).assign(**{column: tag_texts(batch[text].tolist(), local, words)})

    return run


def with_tag_counts(lines: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """Adds the nine word-class counts of each line from the tagger's tags."""
    tagged = tagger.tag(lines, text, "_tags")
    return tagged.select(*[c for c in lines.columns], *tag_counts("_tags"))


