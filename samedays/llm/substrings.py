"""Removal of passages that occur earlier in the corpus, by suffix automata over reference shards.

A window of `WINDOW` consecutive words is removed if the same words also start earlier: in a smaller document, or in
the same document before. Windows are judged on the input.

1. Anchors. Each window chooses one of its runs of `ANCHOR` words by least hash, so equal windows choose equal
   anchors at equal offsets. A text has an anchor about every eighth word; only (anchor, row) pairs are shuffled.
2. Segments. Windows whose anchor occurs once cannot repeat. The windows around each repeated anchor form a segment
   of 20 to 34 words, keyed by the anchor. Where an anchor occurs more than `HOT` times each window is a segment of
   its own, keyed by its own hash, so that a common run of words does not gather all its contexts in one task.
3. Reference shards. The segments of a key are its shard, `HOT` at most; equal ones of a batch are sent once, as their
   earliest place. They stream in order of place through a suffix automaton of the different ones before, and words
   whose matching statistic reaches the window's length end a repeated window. Sending the automaton's shard to the
   texts that need it, by key, takes the place of broadcasting every shard to every text, which would be quadratic in
   the corpus.
4. What comes back to a text are the segments that are the first of their kind, with the spans found in them. All its
   other repeated segments occur earlier as a whole. The spans are cut out of the text.

Words are compared as words; hashes only route. Texts are shuffled once, compressed; both readers share that exchange.

Defined results: null texts have no words. Rows with the same id are in the order of a hash of id and text; rows with
the same id and text are the same document, so none of them is earlier and each is cut alike. Null ids come after all
others. Texts under `WINDOW` words stay whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 20
ANCHOR = 6
#: Occurrences of an anchor beyond which its windows are keyed one by one.
HOT = 1000
#: Stands for a null id, which comes after all others.
NO_ID = (1 << 63) - 1
#: Bytes of text that are hashed at once (a longer text is hashed by itself, whole).
CHUNK = 1 << 20

_RANDOM = np.random.default_rng(20)
_BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _STEP = np.uint64(0x9E3779B97F4A7C13), np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashed:
    """Words of several texts, hashed: `text_of` and `place` of each word, and the anchor of each window."""

    _up, _down = _powers(_BASE, CHUNK + 2), _powers(_INVERSE, CHUNK + 2)

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        n = len(data)
        up, down = (self._up, self._down) if n <= CHUNK + 1 else (_powers(_BASE, n + 1), _powers(_INVERSE, n + 1))
        white = _WHITE[data]
        before = np.empty(n, bool)
        before[0], before[1:] = True, white[:-1]
        starts, ends = np.flatnonzero(before & ~white), np.flatnonzero(~before & white)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:n], out=total[1:])
        word = _mixed((total[ends] - total[starts]) * down[starts])
        edges = np.cumsum([len(t) + 1 for t in texts])
        self.text_of = np.searchsorted(edges, starts, side="right")
        self.first = np.searchsorted(self.text_of, np.arange(len(texts)))
        self.word = word
        self.whole = self._run(WINDOW)
        self._anchor()

    def _run(self, length: int) -> np.ndarray:
        """A hash of each run of so many words."""
        count = max(len(self.word) - length + 1, 0)
        out = np.zeros(count, np.uint64)
        for i in range(length):
            out = out * _STEP + self.word[i : i + count]
        return _mixed(out)

    def _anchor(self) -> None:
        """`window`: first words of the windows that lie in one text; `anchor`: the first word of each one's anchor."""
        self.grams = grams = self._run(ANCHOR)
        span = WINDOW - ANCHOR + 1
        least, at, width = grams, np.arange(len(grams)), 1
        while len(least) and width < span:
            step = min(width, span - width)
            left, right = least[:-step] if step else least, least[step:]
            take = left <= right
            least, at, width = np.where(take, left, right), np.where(take, at[: len(left)], at[step:]), width + step
        count = max(len(self.word) - WINDOW + 1, 0)
        inside = self.text_of[:count] == self.text_of[WINDOW - 1 : WINDOW - 1 + count]
        self.window = np.flatnonzero(inside)
        self.anchor = at[: len(self.word)][self.window] if count else np.zeros(0, np.int64)


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK bytes together."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) + 1 > CHUNK:
            yield begin, i
            begin, size = i, 0
        size += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(anchor, row, n): the anchors of each text, with the number of their places there."""
    for batch in batches:
        texts, rows = [t.encode() for t in batch["text"]], batch["row"].to_numpy(np.int64)
        for begin, end in _chunks(texts):
            hashed = Hashed(texts[begin:end])
            places = np.unique(hashed.anchor)
            found = pd.DataFrame({"anchor": hashed.grams[places].view(np.int64), "row": rows[begin:end][hashed.text_of[places]]})
            yield found.groupby(["anchor", "row"], sort=False).size().rename("n").reset_index()


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield batch[["row", "doc_id"]].assign(packed=[packer.compress(t.encode()) for t in batch["text"]])


def _unpacked(packed: list[bytes]) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(p) for p in packed]


class Segment(NamedTuple):
    """Words start to stop of a text, routed by key."""

    key: int
    start: int
    stop: int


def segments_of(hashed: Hashed, i: int, windows: slice, anchors, hot) -> list[Segment]:
    """The segments of a text: runs of windows around each repeated anchor."""
    first, at = hashed.window[windows], hashed.anchor[windows]
    if not len(first) or anchors is None or not len(anchors):
        return []
    known = np.asarray(anchors, np.int64)
    order = np.argsort(known)
    known, is_hot = known[order], np.asarray(hot, bool)[order]
    mine = hashed.grams[at].view(np.int64)
    found = np.minimum(np.searchsorted(known, mine), len(known) - 1)
    repeated = known[found] == mine
    keep = np.flatnonzero(repeated)
    if not len(keep):
        return []
    alone = is_hot[found[keep]]
    # a segment ends where the anchor's place changes, or with each window of a hot anchor
    new = np.ones(len(keep), bool)
    new[1:] = (at[keep][1:] != at[keep][:-1]) | alone[1:]
    begins = np.flatnonzero(new)
    begin, end = keep[begins], keep[np.append(begins[1:] - 1, len(keep) - 1)]
    keys = np.where(alone[begins], hashed.whole[first[begin]].view(np.int64), mine[begin])
    base = hashed.first[i]
    return list(map(Segment, keys.tolist(), (first[begin] - base).tolist(), (first[end] - base + WINDOW).tolist()))


def _each(batch: pd.DataFrame) -> Iterator[tuple[int, bytes, list[Segment]]]:
    """(row of the batch, text, segments) for every text."""
    texts = _unpacked(batch["packed"])
    for begin, end in _chunks(texts):
        hashed = Hashed(texts[begin:end])
        bounds = np.searchsorted(hashed.text_of[hashed.window], np.arange(end - begin + 1)).tolist()
        for i in range(end - begin):
            anchors, hot = batch["anchors"].iloc[begin + i], batch["hot"].iloc[begin + i]
            yield begin + i, texts[begin + i], segments_of(hashed, i, slice(bounds[i], bounds[i + 1]), anchors, hot)


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, doc_id, row, start, words): the segments of a batch, of equal ones the earliest."""
    for batch in batches:
        rows, ids = batch["row"].tolist(), batch["doc_id"].tolist()
        places: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        for n, text, segments in _each(batch):
            split = text.split() if segments else []
            for key, start, stop in segments:
                place, held = (ids[n], rows[n], start), (key, b" ".join(split[start:stop]))
                if place < places.get(held, (NO_ID + 1,)):
                    places[held] = place
        out = [(key, *place, words.decode()) for (key, words), place in places.items()]
        yield pd.DataFrame(out, columns=["key", "doc_id", "row", "start", "words"])


class SuffixAutomaton:
    """All runs of words of the texts added so far, as states: word -> state, suffix link, longest run."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.longest = [-1], [0]

    def _state(self, longest: int, link: int, following: dict[str, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.longest.append(longest)
        return len(self.next) - 1

    def _split(self, state: int, word: str, target: int) -> int:
        """A copy of target for runs no longer than that of state and one word."""
        clone = self._state(self.longest[state] + 1, self.link[target], dict(self.next[target]))
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        self.link[target] = clone
        return clone

    def add(self, text: list[str]) -> None:
        last = 0
        for word in text:
            if (target := self.next[last].get(word)) is not None:  # an earlier text has this run already
                last = target if self.longest[target] == self.longest[last] + 1 else self._split(last, word, target)
                continue
            new = self._state(self.longest[last] + 1, 0, {})
            state = last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            if state >= 0:
                target = self.next[state][word]
                exact = self.longest[target] == self.longest[state] + 1
                self.link[new] = target if exact else self._split(state, word, target)
            last = new

    def statistics(self, text: list[str]) -> list[int]:
        """For each word, the length of the longest run that ends there and occurs in an added text."""
        state, length, out = 0, 0, []
        for word in text:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.longest[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            out.append(length)
        return out


def spans_of(statistics: list[int], window: int = WINDOW) -> list[int]:
    """Maximal spans covered by windows that end where the statistic reaches the window: start, length, start, ..."""
    out: list[int] = []
    for i, length in enumerate(statistics):
        if length >= window:
            start = i + 1 - window
            if out and start <= out[-2] + out[-1]:
                out[-1] = i + 1 - out[-2]
            else:
                out += [start, window]
    return out


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc_id, row, start, spans) for the first of each kind of segment, sorted by key and place."""
    key, automaton, seen = None, None, set()
    for batch in batches:
        out = []
        for k, doc_id, row, start, words in batch[["key", "doc_id", "row", "start", "words"]].itertuples(index=False, name=None):
            if k != key:
                key, automaton, seen = k, None, {words}
                out.append((doc_id, row, start, []))
                continue
            if words in seen:
                continue
            if automaton is None:  # only made if the shard has a second kind of segment
                automaton = SuffixAutomaton()
                automaton.add(next(iter(seen)).encode().split())
            seen.add(words)
            found = words.encode().split()
            out.append((doc_id, row, start, spans_of(automaton.statistics(found))))
            automaton.add(found)
        yield pd.DataFrame(out, columns=["doc_id", "row", "start", "spans"])


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for n, text, segments in _each(batch):
            split = text.split()
            doc_id, firsts = batch["doc_id"].iloc[n], batch["firsts"].iloc[n]
            own = {} if firsts is None else {f["start"]: f["spans"] for f in firsts if f["doc_id"] == doc_id}
            removed = np.zeros(len(split) + 1, np.int64)
            for _, start, stop in segments:
                inner = own.get(start)
                if inner is None:  # not the first of its kind
                    removed[start] += 1
                    removed[stop] -= 1
                    continue
                for offset, length in zip(inner[::2], inner[1::2], strict=True):
                    removed[start + offset] += 1
                    removed[start + offset + length] -= 1
            gone = np.cumsum(removed[:-1]) > 0
            kept = b" ".join([w for w, g in zip(split, gone.tolist(), strict=True) if not g]).decode()
            out.append((doc_id, len(split), int(gone.sum()), kept))
        yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every document: kept has the words left, joined by one space."""
    source = documents.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("row", F.xxhash64("doc_id", "text"))
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = source.mapInPandas(_packed, "row long, doc_id long, packed binary")
    texts = packed.repartition(partitions, "row")

    anchors = source.select("row", "text").mapInPandas(_anchors, "anchor long, row long, n int")
    repeated = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor", (F.col("n") > HOT).alias("hot"))
    marked = anchors.select("anchor", "row").join(repeated, "anchor")
    by_row = marked.groupBy("row").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("hot").alias("hot"))

    schema = "key long, doc_id long, row long, start int, words string"
    segments = texts.join(by_row, "row").select("row", "doc_id", "packed", "anchors", "hot").mapInPandas(_segments, schema)
    ordered = segments.repartition("key").sortWithinPartitions("key", "doc_id", "row", "start")
    judged = ordered.mapInPandas(_judge, "doc_id long, row long, start int, spans array<int>")
    firsts = judged.groupBy("row").agg(F.collect_list(F.struct("doc_id", "start", "spans")).alias("firsts"))

    whole = texts.join(by_row, "row", "left").join(firsts, "row", "left").select("row", "doc_id", "packed", "anchors", "hot", "firsts")
    kept = whole.mapInPandas(_cut, "doc_id long, n_words long, n_removed long, kept string")
    return kept.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
