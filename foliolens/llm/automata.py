"""Substring dedup over words with suffix automata of reference shards."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliolens.llm.jaccard import _table
from foliolens.llm.kernels import chunks, gram_hashes, word_hashes, words
from foliolens.llm.repeats import anchors, candidates, expand, read_places, union_spans
from foliolens.llm.store import targets

WINDOW = 13
GRAM = 7
#: Fragments and windows that one task holds before it sends them.
HELD = 200_000
EMPTY = hashlib.sha256(b"").digest()


def measure(offsets: np.ndarray, data: np.ndarray):
    starts, ends, first = words(offsets, data)
    tokens = word_hashes(data, starts, ends)
    raw, edges = data.tobytes(), offsets.tolist()
    texts = [raw[a:b] for a, b in zip(edges[:-1], edges[1:])]
    kept = [hashlib.sha256(b" ".join(t.split())).digest() for t in texts]
    return np.diff(first).tolist(), [hashlib.sha256(t).digest() for t in texts], kept, anchors(gram_hashes(tokens, GRAM), GRAM, first, WINDOW)


class Automaton:
    """Suffix automaton of several word sequences; every state knows the smallest document its strings end in."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]

    def _state(self, length: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.least.append(None)
        return len(self.next) - 1

    def add(self, sequence: list[bytes], doc: int) -> None:
        nxt, link, length, least, last = self.next, self.link, self.length, self.least, 0
        for word in sequence:
            have = nxt[last].get(word)
            if have is not None and length[have] == length[last] + 1:
                last = have
            else:
                fresh = None if have is not None else self._state(length[last] + 1, {}, 0)
                p = last
                while fresh is not None and p >= 0 and word not in nxt[p]:
                    nxt[p][word] = fresh
                    p = link[p]
                if p >= 0:
                    q = nxt[p][word]
                    if length[p] + 1 == length[q]:
                        target = q
                    else:
                        target = self._state(length[p] + 1, dict(nxt[q]), link[q])
                        link[q] = target
                        while p >= 0 and nxt[p].get(word) == q:
                            nxt[p][word] = target
                            p = link[p]
                    if fresh is not None:
                        link[fresh] = target
                    last = target if fresh is None else fresh
                else:
                    last = fresh
            if least[last] is None or doc < least[last]:
                least[last] = doc

    def finish(self) -> None:
        """Strings of a state also end where those of the states below it do."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up, doc = self.link[state], self.least[state]
            if up > 0 and doc is not None and (self.least[up] is None or doc < self.least[up]):
                self.least[up] = doc

    def covered(self, sequence: list[bytes], doc: int, window: int) -> list[int]:
        """Starts of the windows whose words also occur in a smaller document, from the matching statistics of the sequence."""
        state, matched, out = 0, 0, []
        for i, word in enumerate(sequence):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(word, 0)
            matched = matched + 1 if state else 0
            if matched >= window:
                at = state
                while self.length[self.link[at]] >= window:
                    at = self.link[at]
                if self.least[at] is not None and self.least[at] < doc:
                    out.append(i - window + 1)
        return out


FRAGMENTS = "target int, key long, doc_id long, first long, text binary, last long"
_FRAGMENTS = pa.schema([
    ("target", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()), ("text", pa.binary()), ("last", pa.int64()),
])


def _fragments(pieces: int):
    """Windows around each place as one fragment; fragments met before in the task are settled, others go to the shard of their anchor.

    Around a hot anchor each window goes by its own digest, in the smallest document of the task that has it; in others it is settled.
    """

    def run(batches):
        held: dict[tuple[int, bytes], tuple[int, int]] = {}
        whole: dict[bytes, int] = {}
        windows: dict[bytes, tuple[int, list[int]]] = {}

        def settle(doc, first, text):
            return span(doc, first, first + text.count(b" ") + 1)

        def span(doc, first, last):
            return {"target": doc % pieces, "doc_id": doc, "first": first, "last": last}

        def apart(doc, tokens, first, end, out):
            text = b" ".join(tokens[first:end])
            met = whole.get(text)
            if met is not None and met < doc:
                out.append(settle(doc, first, text))
                return
            whole[text] = doc
            for at in range(first, end - WINDOW + 1):
                name = hashlib.sha256(b" ".join(tokens[at : at + WINDOW])).digest()
                met = windows.get(name)
                if met is None:
                    windows[name] = doc, [at]
                elif doc == met[0]:
                    met[1].append(at)
                elif doc > met[0]:
                    out.append(span(doc, at, at + WINDOW))
                else:
                    out.extend(span(met[0], x, x + WINDOW) for x in met[1])
                    windows[name] = doc, [at]

        def send():
            rows = [
                {"target": (k >> 20) % pieces, "key": k, "doc_id": doc, "first": first, "text": text}
                for (k, text), (doc, first) in held.items()
            ]
            rows += [
                {"target": int.from_bytes(name[:4], "big") % pieces, "doc_id": doc, "first": at, "text": name}
                for name, (doc, places) in windows.items() for at in places
            ]
            held.clear()
            whole.clear()
            windows.clear()
            return _table(_FRAGMENTS, rows)

        for batch in batches:
            out = []
            for doc, packed, blob in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "places"))):
                text = expand(packed)
                tokens = text.translate(_SPACES).split()
                raw = np.frombuffer(text, np.uint8)
                starts, ends, _ = words(np.array([0, len(raw)]), raw)
                keys = gram_hashes(word_hashes(raw, starts, ends), GRAM).view(np.int64)
                for at, least, most, hot in zip(*(c.tolist() for c in read_places(blob))):
                    first, end = at - most, at - least + WINDOW
                    if hot:
                        apart(doc, tokens, first, end, out)
                        continue
                    name = int(keys[at]), b" ".join(tokens[first:end])
                    met = held.get(name)
                    if met is None or doc < met[0]:
                        held[name] = doc, first
                        if met is not None:
                            out.append(settle(*met, name[1]))
                    elif doc > met[0]:
                        out.append(settle(doc, first, name[1]))
                    else:  # the same document again: its fate is that of its first occurrence, so it goes along
                        out.append({"target": (name[0] >> 20) % pieces, "key": name[0], "doc_id": doc, "first": first, "text": name[1]})
            yield _table(_FRAGMENTS, out)
            if len(held) + len(whole) + len(windows) >= HELD:
                yield send()
        yield send()

    return run


_SPACES = bytes(32 if i in (9, 10, 11, 12, 13) else i for i in range(256))


def _remove(table: pa.Table) -> pa.Table:
    """Spans of words to remove in the fragments of one shard."""
    docs, firsts, spans = table.column("doc_id").to_pylist(), table.column("first").to_pylist(), []
    groups: dict[int, dict[bytes, list[int]]] = {}
    windows: dict[bytes, list[int]] = {}
    for i, (key, text, last) in enumerate(zip(*(table.column(c).to_pylist() for c in ("key", "text", "last")))):
        if text is None:  # settled before
            spans.append((docs[i], firsts[i], last))
            continue
        if key is None:  # a window of a hot anchor, by its digest
            windows.setdefault(text, []).append(i)
            continue
        groups.setdefault(key, {}).setdefault(text, []).append(i)
    for rows in windows.values():
        least = min(docs[i] for i in rows)
        spans += [(docs[i], firsts[i], firsts[i] + WINDOW) for i in rows if docs[i] > least]
    for texts in groups.values():
        least = {t: min(docs[i] for i in rows) for t, rows in texts.items()}
        shard = None
        if len(texts) > 1:
            shard = Automaton()
            for t, doc in least.items():
                shard.add(t.split(b" "), doc)
            shard.finish()
        for t, rows in texts.items():
            sequence = t.split(b" ")
            inside = shard.covered(sequence, least[t], WINDOW) if shard else []
            for i in rows:
                if docs[i] > least[t]:
                    spans.append((docs[i], firsts[i], firsts[i] + len(sequence)))
                else:
                    spans += [(docs[i], firsts[i] + s, firsts[i] + s + WINDOW) for s in inside]
    doc, first, last = zip(*spans) if spans else ((), (), ())
    return pa.table({"doc_id": pa.array(doc, pa.int64()), "first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64())})


CUT = "doc_id long, n_removed long, kept binary, kept_text string"


def _cut(text_too: bool):
    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "packed", "firsts", "lasts")]
            out = ([], [], [], [])
            for doc, packed, firsts, lasts in zip(*columns):
                tokens, kept, done = expand(packed).translate(_SPACES).split(), [], 0
                for a, b in zip(*union_spans(np.array(firsts), np.array(lasts))):
                    kept += tokens[done:a]
                    done = b
                kept += tokens[done:]
                joined = b" ".join(kept)
                for column, value in zip(out, (doc, len(tokens) - len(kept), hashlib.sha256(joined).digest(), joined.decode() if text_too else None)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "n_removed", "kept", "kept_text"])

    return run


def substring_dedup(docs: DataFrame, texts: bool = False) -> DataFrame:
    """Remove each word covered by a 13-word window that also starts in a document of smaller doc_id.

    Places whose anchor occurs in several documents are found first (see `repeats`); the windows around them go, as fragments, to the
    reference shard of their anchor, so that every window meets all windows it can equal and no shard has to visit every task.
    A shard builds a suffix automaton over each group's distinct fragments whose states know the smallest document, and streams the fragments
    through it: where the matching statistic reaches 13 words, the state of those 13 words tells whether a smaller document has them.
    Windows around an anchor of more than 2,000 places are dealt by their own digests instead, one per task for each, so that no shard holds them all.
    Words are compared as bytes.

    Words are maximal runs of [^\\x20\\x09-\\x0D].  Returns a row per input row: doc_id, n_words, n_removed, kept_sha256, and with `texts`
    kept_text, which is null where nothing was removed.  Null texts have no words.  Equal texts are all removed but the one of the smallest doc_id
    (unless under 13 words); rows of one doc_id count as one document and are expected to have one text; rows without doc_id neither remove nor lose words.
    An empty table gives no rows; other columns are ignored.
    """
    pieces = targets(docs)
    documents, classes, cand = candidates(docs, measure, False, "words")
    sent = cand.mapInArrow(_fragments(pieces), FRAGMENTS)
    matched = sent.repartition(pieces, "target").groupBy("target").applyInArrow(_remove, "doc_id long, first long, last long")
    spans = matched.groupBy("doc_id").agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    cut = cand.select("doc_id", "packed").join(spans, "doc_id").mapInArrow(_cut(texts), CUT).withColumnsRenamed({"kept": "cut_kept"})
    rows = documents.join(classes, "digest").join(cut, "doc_id", "left")
    copy = (F.col("doc_id") > F.col("rep")) & (F.col("n") >= WINDOW)
    removed = F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0)))
    kept = F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("cut_kept", "kept"))
    extra = [F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if texts else []
    return rows.select("doc_id", F.col("n").alias("n_words"), removed.cast("long").alias("n_removed"), F.lower(F.hex(kept)).alias("kept_sha256"), *extra)
