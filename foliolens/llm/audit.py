"""How the filters of a corpus interact, in every order of applying them, in built-in functions only."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliolens.llm.store import stage
from foliolens.plans.lineage import fits_broadcast, if_small, repeated_for, sized_join

LETTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"
FEWEST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKUP = 50, 65, 5, r"[#$%&*|]"
#: Pieces of a hot key where the other side cannot be broadcast.
PIECES = 64
#: Rows of hashes, with a doc_id, that are broadcast at most: some 100 MB where they are sent from.
HASH_ROWS = 500_000


def text_failures(text: Column, found: Column) -> list[Column]:
    """Conditions under which a text with its words fails A: few words, B: few distinct words, C: many capitals, D: characters of markup."""
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]", ""))
    return [
        F.size(found) < FEWEST_WORDS,
        100 * F.size(F.array_distinct(found)) < LEAST_DISTINCT * F.size(found),
        100 * capitals > MOST_CAPITALS * F.char_length(text),
        text.rlike(MARKUP),
    ]


def _semi(rows: DataFrame, earlier: DataFrame, same: list[str]) -> DataFrame:
    """Rows for which `earlier` has equal columns and a smaller doc_id in `first`; hot keys are spread where `earlier` is too large to broadcast."""
    if fits_broadcast(earlier, HASH_ROWS):
        earlier = F.broadcast(earlier)
    else:
        earlier = repeated_for(earlier, PIECES)
        rows, same = rows.withColumn("_piece", F.pmod(F.xxhash64("doc_id"), F.lit(PIECES)).cast("int")), [*same, "_piece"]
    a, b = rows.alias("a"), earlier.alias("b")
    match = F.col("b.first") < F.col("a.doc_id")
    for column in same:
        match = match & (F.col(f"a.{column}") == F.col(f"b.{column}"))
    return a.join(b, match, "left_semi").drop("_piece")


def later_copies(keys: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of `keys` whose text some smaller doc_id has too: a left-semi self-join on hash, exact text and smaller doc_id.

    `keys` has doc_id and key (a hash of the text) of all rows, `texts` the same columns and text.  Texts of keys that occur once are
    never shuffled.  The others are grouped by key and exact text, after each task has grouped its own, so that a text in a third of all
    rows moves once per task.  Where a key stands for one text, which the grouping proves, rows are joined by key and smaller doc_id and
    need no text; where different texts share a key, rows are joined by their text too.
    """
    repeated = stage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "repeated")
    candidates = sized_join(texts, repeated, ["key"], "left_semi", "doc_id", rows=HASH_ROWS)
    originals = stage(candidates.groupBy("key", "text").agg(F.min("doc_id").alias("first")), "originals")
    shared = stage(originals.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first")), "shared-keys")
    found = _semi(keys, shared.filter("n = 1").select("key", "first"), ["key"])
    mixed = shared.filter("n > 1").select("key")
    if mixed.isEmpty():
        return found
    mixed_texts = sized_join(texts, mixed, ["key"], "left_semi", "doc_id", rows=HASH_ROWS)
    return found.unionByName(_semi(mixed_texts, originals.join(mixed, "key", "left_semi"), ["key", "text"]).select(*keys.columns))


def failing_combinations(docs: DataFrame, labels: DataFrame, name: str = "source", key: Column | None = None) -> DataFrame:
    """Rows (part, bits, n, good, toxic): documents, those with quality 1 and those with toxic 1, by the set of filters that they fail.

    Bit 0 is A, bit 4 is E.  `key` replaces the hash of texts, for tests.
    """
    part, text = F.coalesce(F.col(name).cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), text.alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text") if key is None else key)
    found = rows.withColumn("found", F.array_remove(F.split("text", SPACE), ""))
    bits = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(text_failures(F.col("text"), F.col("found")))), F.lit(0))
    own = stage(found.select("doc_id", "part", "key", bits.alias("bits")), "failures")
    keys = ["doc_id", "part", "key"]
    copies = later_copies(own.select(*keys), rows)
    # Ids of copies are united with the others; rows are counted once, in the first half.
    united = own.select(*keys, "bits", F.lit(1).alias("rows")).unionByName(copies.select(*keys, F.lit(1 << 4).alias("bits"), F.lit(0).alias("rows")))
    marked = united.groupBy(*keys).agg(F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows"))
    marks = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int").alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))),
    )
    marks = marks.filter("doc_id is not null").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    return (
        marked.join(if_small(marks), "doc_id", "left")
        .groupBy("part", "bits")
        .agg(F.sum("rows").alias("n"), *(F.coalesce(F.sum(F.col("rows") * F.col(c)), F.lit(0)).alias(c) for c in ("good", "toxic")))
    )


def _steps() -> Column:
    """filter_order, step, the number of its filter and the bits of those before, for all steps of all orders."""
    rows = []
    for order in itertools.permutations(range(len(LETTERS))):
        for i, f in enumerate(order):
            rows.append((("".join(LETTERS[k] for k in order)), i + 1, f, sum(1 << k for k in order[:i])))
    return F.expr("array(%s)" % ", ".join(f"struct('{o}' as filter_order, {s} as step, {f} as own, {p} as before)" for o, s, f, p in rows))


def _weight(before: int, n: int = len(LETTERS)) -> int:
    """Orders in which exactly these filters come before a given one."""
    k = before.bit_count()
    return math.factorial(k) * math.factorial(n - 1 - k)


def interactions(combinations: DataFrame) -> DataFrame:
    """From rows (part, bits, n, good, toxic) to a row per part, order and step: what the step's filter removes, and what others already had.

    Each part becomes one row of 3 x 32 counts; all steps follow from these without a further shuffle.
    """
    sets = range(1 << len(LETTERS))
    counts = [
        F.array(*(F.coalesce(F.sum(F.when(F.col("bits") == k, F.col(c))), F.lit(0)) for k in sets)).alias(c) for c in ("n", "good", "toxic")
    ]
    # By filter: the number of documents it removes, over all orders.  Each set of earlier filters counts as often as it occurs.
    value = []
    for f in range(len(LETTERS)):
        others = [s for s in sets if not s >> f & 1]
        weights = {k: sum(_weight(s) for s in others if not s & k) for k in sets if k >> f & 1}
        value.append(sum((F.col("n")[k] * w for k, w in weights.items()), F.lit(0)))
    parts = combinations.groupBy("part").agg(*counts).withColumn("value", F.array(*value))
    rows = parts.select("*", F.inline(_steps()))

    def total(column: str, condition) -> Column:
        picked = F.transform(F.col(column), lambda x, k: F.when(condition(k), x).otherwise(F.lit(0)))
        return F.aggregate(picked, F.lit(0).cast("long"), lambda a, b: a + b)

    bit, before = F.element_at(F.array(*(F.lit(1 << f) for f in range(len(LETTERS)))), F.col("own") + 1), F.col("before")
    fails = lambda k: k.bitwiseAND(bit) != 0
    removed = lambda k: fails(k) & (k.bitwiseAND(before) == 0)
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda k: k.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda k: fails(k) & (k.bitwiseAND(before) != 0)).alias("redundant"),
        F.col("n")[bit].alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        F.col("value")[F.col("own")].cast("long").alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part (source), order of the five filters and step, with long counts of documents within the part.

    kept after the step, removed in it, redundant (fail its filter, removed before), unique_fails (fail this filter only), good_lost and
    toxic_lost (removed here, label 1), shapley (removed by its filter, over all 120 orders).

    Rows count one by one, repeated ones too; copies are texts that some strictly smaller doc_id has, in any part, so repeated rows of one doc_id
    are no copies of each other, and rows without doc_id are neither copies nor originals.  Null text counts as empty (fails A), a null
    source as part ''.  Labels may repeat (any 1 counts) or miss.  Long texts are read whole in one scan for A to D; texts move only where
    their hash occurs again.  Empty documents give no rows; other columns are ignored.
    """
    return interactions(failing_combinations(docs, labels))
