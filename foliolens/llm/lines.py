"""Line dedup by an exact set-similarity join, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foliolens.llm.store import fresh, stage

#: Similarity of at least 80 / 100.
PERCENT = 80
#: Counters of the rarity table; tokens share them by hash, so the table has one size for any vocabulary.
COUNTERS = 1 << 20
_HASH_BITS = 57
#: Rarity class from which on the sets of a token are first compared with the earliest of them: at least 1,024 occurrences.
HOT = 11
#: Sets of more tokens have a second bitmap, as one of 64 bits tells them apart badly.
WIDE = 80
#: Words of 64 bits in the filter of lines to be read again; of one size for any input.
FILTER_WORDS = 1 << 16


def _plain(text: Column) -> Column:
    """The text with a space for each white character but newlines, so that splitting at one character finds its tokens."""
    some = F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\x0b")) | F.contains(text, F.lit("\x0c")) | F.contains(text, F.lit("\r"))
    return F.when(some, F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)


def _lines(docs: DataFrame) -> DataFrame:
    text = F.coalesce(_plain(F.col("text")), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def _hashes(line: Column) -> Column:
    """Distinct tokens of a line of plain text, as 64-bit hashes."""
    return F.array_distinct(F.transform(F.array_remove(F.split(line, " "), ""), lambda t: F.xxhash64(t)))


def rarity(docs: DataFrame) -> Column:
    """Array with a rarity class for each counter: the bits of the number of token occurrences that fell on it, over all texts."""
    text = F.replace(_plain(F.col("text")), F.lit("\n"), F.lit(" "))
    tokens = docs.select(F.explode(F.split(text, " ")).alias("token")).filter("token <> ''")
    counted = tokens.groupBy(F.xxhash64("token").bitwiseAND(F.lit(COUNTERS - 1)).alias("counter")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    found = dict(zip(counted.column("counter").to_pylist(), counted.column("n").to_pylist()))
    classes = ",".join(str(min(62, found.get(i, 0).bit_length())) for i in range(COUNTERS))
    return F.split(F.lit(classes), ",").cast("array<tinyint>")  # folded to one constant


def _ordered(line: Column, classes: Column) -> Column:
    """Distinct tokens of a line as numbers that ascend from rare to frequent: the class in front of a 57-bit hash."""

    def number(h: Column) -> Column:
        rank = F.coalesce(F.get(classes, h.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")), F.lit(0).cast("tinyint"))
        return F.shiftleft(rank.cast("long"), _HASH_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - _HASH_BITS))

    return F.sort_array(F.transform(_hashes(line), number))


def _needed(size: str) -> str:
    """Least number of shared tokens of a set with any set as similar as asked."""
    return f"int(({size} * {PERCENT} + 99) div 100)"


def _shared(sizes: str) -> str:
    """Least number of shared tokens of two similar sets with so many tokens together."""
    return f"int(({sizes} * {PERCENT} + {99 + PERCENT}) div {100 + PERCENT})"


def _measured(docs: DataFrame, classes: Column) -> DataFrame:
    """Each line's place, the key of its token set, its size, a parity bitmap, and its rarest tokens: as many as leave too few for a match.

    Of the rarest tokens 31 bits are kept, negative for frequent ones, since chance repeats only make candidates.
    """
    parity = "aggregate(%s, 0L, (seen, t) -> seen ^ shiftleft(1L, cast(t & 63 as int)))"
    tokens = _lines(docs).select("doc_id", "line_no", _ordered(F.col("line"), classes).alias("tokens"))
    prefix = f"slice(tokens, 1, size(tokens) - {_needed('size(tokens)')} + 1)"
    return tokens.select(
        "doc_id", "line_no", F.xxhash64("tokens").alias("k1"), F.xxhash64(F.lit(7), "tokens").alias("k2"),
        F.size("tokens").alias("size"), F.expr(parity % "tokens").alias("bits"),
        F.expr(f"if(size(tokens) > {WIDE}, {parity % 'filter(tokens, t -> t & 64 > 0)'}, null)").alias("odd"),
        F.expr(
            f"transform({prefix}, t -> cast(shiftrightunsigned(t, 26) & {2**31 - 1} as int) ^ if(t < {HOT << _HASH_BITS}L, 0, -1))"
        ).alias("prefix"),
    )


_PLACE = ["doc_id", "line_no"]
_ROW = [*_PLACE, "size", "bits", "odd", "at"]
_EARLIER = "(doc_id_a < doc_id_b or (doc_id_a = doc_id_b and line_no_a < line_no_b))"
#: Sizes, the most tokens that can still be shared from the shared one on, and the bits in which bitmaps differ (at most as many as
#: tokens) allow the similarity of sets a and b.
_MAY_MATCH = f"""
    least(size_a, size_b) * 100 >= greatest(size_a, size_b) * {PERCENT}
    and (least(at_a, at_b) + least(size_a - at_a, size_b - at_b)) * {100 + PERCENT} >= {PERCENT} * (size_a + size_b)
    and coalesce(bit_count(odd_a ^ odd_b) + bit_count(bits_a ^ odd_a ^ bits_b ^ odd_b), bit_count(bits_a ^ bits_b))
        <= size_a + size_b - 2 * {_shared('(size_a + size_b)')}
"""


def _postings(sets: DataFrame, *more: str) -> DataFrame:
    return sets.select(*_PLACE, "size", "bits", "odd", *more, F.posexplode("prefix").alias("at", "token"))


def _side(rows: DataFrame, x: str, *more: str) -> DataFrame:
    return rows.select("token", *(F.col(c).alias(f"{c}_{x}") for c in _ROW), *more)


def _may_match(pairs: DataFrame, name: str) -> DataFrame:
    """Distinct pairs of places, the earlier first, of sets that share a rare token and may match."""
    place = lambda x: F.struct(*(F.col(f"{c}_{x}").alias(c) for c in _PLACE))
    found = pairs.filter(_MAY_MATCH).filter("doc_id_a <> doc_id_b or line_no_a <> line_no_b").select(F.least(place("a"), place("b")).alias("a"), F.greatest(place("a"), place("b")).alias("b"))
    return stage(found.select(*(F.col(f"{x}.{c}").alias(f"{c}_{x}") for x in "ab" for c in _PLACE)).distinct(), name)


def _among(found: DataFrame, *columns: str) -> Column:
    """Whether a row may be among the found ones by the given columns: a bit for each hash, in a table of one size."""
    h = F.xxhash64(*columns)
    word, bit = h.bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int"), F.shiftrightunsigned(h, 58).cast("int")
    one = F.expr("shiftleft(1L, bit)")
    words = found.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or(one).alias("bits")).toArrow()
    known = dict(zip(words.column("word").to_pylist(), words.column("bits").to_pylist()))
    table = F.split(F.lit(",".join(str(known.get(i, 0)) for i in range(FILTER_WORDS))), ",").cast("array<long>")
    return F.getbit(F.get(table, word), bit) == 1


def _verified(docs: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
    """Places of later sets that match; texts are read again, for the lines of the pairs only."""
    place = lambda x: F.struct(*(F.col(f"{c}_{x}").alias(c) for c in _PLACE))
    wanted = stage(pairs.select(F.explode(F.array(place("a"), place("b"))).alias("p")).select("p.*").distinct(), f"{name}-wanted")
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(_among(wanted, "doc_id"))
    again = _lines(some).filter(_among(wanted, *_PLACE))
    whole = stage(again.join(wanted, _PLACE, "left_semi"), f"{name}-lines")
    side = lambda x: whole.select(*(F.col(c).alias(f"{c}_{x}") for c in (*_PLACE, "line")))
    joined = pairs.join(side("a"), ["doc_id_a", "line_no_a"]).join(side("b"), ["doc_id_b", "line_no_b"])
    sets = joined.select("doc_id_b", "line_no_b", *(_hashes(F.col(f"line_{x}")).alias(f"tokens_{x}") for x in "ab"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    good = sets.filter(both * (100 + PERCENT) >= PERCENT * (F.size("tokens_a") + F.size("tokens_b")))
    return stage(good.select(*(F.col(f"{c}_b").alias(c) for c in _PLACE)).distinct(), name)


def marked_lines(docs: DataFrame) -> DataFrame:
    """Every line of the documents with `gone`: whether an earlier line has a similar token set.

    Lines with equal token sets are one set, at the place of the first; all others of them are gone.  Whether the first is gone too takes
    one earlier set that matches.  Sets are indexed under their rarest tokens.  Those that share a frequent one are first compared
    with the earliest of them, which settles groups of near copies without their pairs; sets not gone yet are then compared with
    all others that share a token and pass the length, positional and bitmap filters.  Of two such sets the smaller needs
    only the tokens that a set of its own size must share.
    """
    measured = stage(_measured(docs, rarity(docs)), "lines")
    columns = [*_PLACE, "size", "bits", "odd", "prefix"]
    first = F.min(F.struct(*columns)).alias("s")
    sets = stage(measured.filter("size > 0 and doc_id is not null").groupBy("k1", "k2").agg(first).select("k1", "k2", "s.*"), "line-first")
    # A set of fewer than four tokens is similar to none but itself.
    indexed = sets.filter("size >= 4").select(*columns)
    pivot = F.first(F.struct(*_ROW)).over(W.partitionBy("token").orderBy(*_PLACE))
    first_of = _postings(indexed).filter("token < 0").withColumn("pivot", pivot)
    stars = first_of.select(
        *(F.col(f"pivot.{c}").alias(f"{c}_a") for c in _ROW), *(F.col(c).alias(f"{c}_b") for c in _ROW)
    )
    settled = _verified(docs, _may_match(stars.filter(_EARLIER), "line-stars"), "settled")
    known = indexed.join(settled.withColumn("settled", F.lit(True)), _PLACE, "left").withColumn("settled", F.coalesce("settled", F.lit(False)))
    # Settled sets meet open ones only, under all of their rarest tokens.
    index = _postings(known, "settled").filter(f"settled or at <= size - {_shared('(2 * size)')}")
    rest = _side(index, "a", "settled").join(_side(_postings(known.filter("not settled")), "b"), "token").filter(
        f"if(settled, {_EARLIER}, size_a < size_b or (size_a = size_b and {_EARLIER}))"
    )
    more = _verified(docs, _may_match(rest, "line-pairs"), "settled-later")
    gone = settled.unionByName(more).withColumn("gone", F.lit(True))
    firsts = sets.select("k1", "k2", *_PLACE).join(gone, _PLACE, "left").select(
        "k1", "k2", F.col("doc_id").alias("_doc"), F.col("line_no").alias("_line"), F.coalesce("gone", F.lit(False)).alias("gone")
    )
    own = F.expr("doc_id = _doc and line_no = _line")
    return measured.select(*_PLACE, "k1", "k2").join(firsts, ["k1", "k2"], "left").select(
        *_PLACE, F.when(F.col("gone").isNull() | F.col("doc_id").isNull(), False).when(own, F.col("gone")).otherwise(True).alias("gone")
    )


def line_dedup(docs: DataFrame) -> DataFrame:
    """Remove each line whose token set has a Jaccard similarity of at least 0.8 with that of an earlier line.

    Lines are what newlines part; tokens are maximal runs of [^\\x20\\x09-\\x0D], compared by a 57-bit hash within a pair of lines.  Earlier
    means smaller (doc_id, line_no); removed lines count as earlier ones too.  Lines without tokens are never removed.
    Returns a row per document: doc_id, n_lines, n_removed, removed (line numbers from 0, ascending).  Null and empty texts have one empty
    line.  Rows of one doc_id are one document of which lines of one number are equal places; rows without doc_id neither remove nor lose lines.
    An empty table gives no rows; other columns are ignored.
    """
    return marked_lines(docs).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("gone").alias("n_removed"),
        F.sort_array(F.collect_list(F.when(F.col("gone"), F.col("line_no")))).alias("removed"),
    )


def drop_lines(docs: DataFrame) -> DataFrame:
    """The documents with their text less the removed lines; other columns unchanged.  Rows without doc_id stay whole."""
    lost = fresh(docs, "removed")
    gone = line_dedup(docs).filter("n_removed > 0").select("doc_id", F.col("removed").alias(lost))
    joined = docs.join(gone, "doc_id", "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(lost, i))
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("text", text).select(*docs.columns)
