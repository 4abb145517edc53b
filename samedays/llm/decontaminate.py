"""Benchmark decontamination by latent semantic retrieval, then subsequence and answer checks.

The benchmark is the stated query set. It is taken in blocks of `BLOCK_WORDS` words, so a block's words, vectors and
texts, which every task holds, have a fixed bound whatever the benchmark's size.

1. Every text is cut into words once. What is kept of it, in the shared folder, is the number of each of its words
   among the block's, 0 for other words; no later step needs more. Document frequencies of the block's words are
   counted over all documents. Words in up to `MAX_SHARE` of the documents carry weight, and the `RAREST` rarest words
   of each item, however frequent they are.
2. Every document is cut into passages of `PASSAGE` words, which become normalised TF-IDF rows over the weighted words.
   A randomised SVD is run over all of them and the benchmark's own: each task adds up its part of A'(A Q), the parts
   are added by key, and the driver orthogonalises a matrix of (block's words) x `RANK`.
3. Each passage, now one every `STRIDE` words so that they overlap, is projected and compared with the block's projected passages; pairs at `COSINE` or more are
   candidates. All passages of all documents are compared; nothing is sampled and no list is cut.
4. A candidate is checked on words: the longest common subsequence of the item and the text around the passage,
   as a share of the item. `COPIED` or more is contamination. From `PARAPHRASED` on, the item's answer (column
   `answer` if there is one, else its last `ANSWER` words) must also stand in that text.
5. What the cosine missed is looked up by words, without loss: a text around a passage can hold `COPIED` of an item only
   if it holds `LEAST_RARE` words of the item's rarest (all but as many words as a copy may lack, and `LEAST_RARE` more),
   and can be a paraphrase only if it holds the answer's run. Each such text is checked as in 4, so the result is that
   of the check on every passage, short or widely copied items included.

All items are searched alike, whatever their length; the shortest are found where most of their words stand in order
near each other.

Defined results: null or blank texts and items match nothing. Repeated documents are each reported; repeated items
are one, under the least id. Without documents or items there are no rows. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samedays.llm.common import Scratch, plain_words

PASSAGE, STRIDE = 48, 16
RANK, OVERSAMPLED, ROUNDS = 96, 16, 2
MAX_SHARE, RAREST = 0.02, 6
COSINE = 0.45
COPIED, PARAPHRASED = 0.75, 0.5
ANSWER = 5
BLOCK_WORDS = 20_000
#: Distinct weighted words that a passage needs for a row of its own.
MIN_HITS = 3
#: Rare words of an item that must stand around a passage for it to be checked; any value of 1 or more loses nothing.
LEAST_RARE = 4
#: Neighbouring passages that are first checked together.
TOGETHER = 4
#: Rows of the exchange that adds up the parts of a matrix.
MATRIX_ROWS = 256
#: Bits for a passage's number in its label; the text's number stands above them.
TEXT_SHIFT = 28


def lcs_length(a: Sequence, b: Iterable) -> int:
    """Length of the longest common subsequence, one bit of an integer per word of a."""
    masks: dict = {}
    for i, word in enumerate(a):
        masks[word] = masks.get(word, 0) | (1 << i)
    row = (1 << len(a)) - 1
    full = row
    for word in b:
        mask = masks.get(word)
        if mask:
            common = row & mask
            row = ((row + common) | (row - common)) & full
    return len(a) - row.bit_count()


def holds_run(words: list, run: list) -> bool:
    """Whether the words of a run stand in a list one after the other."""
    at = -1
    for _ in range(words.count(run[0])):
        at = words.index(run[0], at + 1)
        if words[at : at + len(run)] == run:
            return True
    return False


class Item:
    """One benchmark item: its words and its answer, as text or as numbers."""

    def __init__(self, item_id: int, text: str, answer: str | None) -> None:
        self.item_id, self.words = item_id, plain_words(text)
        self.answer = plain_words(answer) or self.words[-ANSWER:]

    def numbered(self, number: dict[bytes, int]) -> Item:
        out = object.__new__(Item)
        out.item_id, out.words, out.answer = self.item_id, [number[w] for w in self.words], [number[w] for w in self.answer]
        return out

    def check(self, near: list) -> tuple[float, bool, bool]:
        """(share of the item's words in the common subsequence, answer found, contaminated)."""
        share = lcs_length(self.words, near) / len(self.words)
        answered = share >= PARAPHRASED and holds_run(near, self.answer)
        return share, answered, share >= COPIED or answered


def _passage_hits(numbers: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(passage, place in numbers) for the weighted words of each passage; a word may be in several passages."""
    at = np.flatnonzero(numbers >= 0)
    many = -(-max(len(numbers) - PASSAGE, 0) // stride)  # number of the last passage, which reaches the end
    passage, place = [], []
    for back in range(-(-PASSAGE // stride)):
        p = at // stride - back
        inside = (p >= 0) & (p <= many) & (at - p * stride < PASSAGE)
        passage.append(p[inside])
        place.append(at[inside])
    return np.concatenate(passage), np.concatenate(place)


class Rows:
    """Normalised TF-IDF rows of many passages, kept as (row, word, weight) sorted by row."""

    def __init__(self, row: np.ndarray, word: np.ndarray, idf: np.ndarray, n_words: int) -> None:
        key, count = np.unique(row * n_words + word, return_counts=True)
        self.label, self.row, hits = np.unique(key // n_words, return_inverse=True, return_counts=True)
        self.word = key % n_words
        self.weight = count * idf[self.word]
        norm = np.sqrt(np.bincount(self.row, self.weight**2, len(self.label)))
        self.weight = self.weight / np.where(norm > 0, norm, 1)[self.row]
        self.hits = hits
        self.begin = np.cumsum(hits) - hits

    def times(self, matrix: np.ndarray, part: int = 200_000) -> np.ndarray:
        """Rows times a matrix with a row per word, some entries at a time."""
        out = np.zeros((len(self.label), matrix.shape[1]), matrix.dtype)
        begin = 0
        while begin < len(self.label):
            end = int(np.searchsorted(self.begin, self.begin[begin] + part))
            end = max(end, begin + 1)
            low, high = self.begin[begin], self.begin[end] if end < len(self.label) else len(self.word)
            product = matrix[self.word[low:high]] * self.weight[low:high, None].astype(matrix.dtype)
            out[begin:end] = np.add.reduceat(product, self.begin[begin:end] - low)
            begin = end
        return out

    def transposed_times(self, values: np.ndarray, n_words: int, part: int = 200_000) -> np.ndarray:
        out = np.zeros((n_words, values.shape[1]))
        order = np.argsort(self.word, kind="stable")
        for begin in range(0, len(order), part):
            chosen = order[begin : begin + part]
            word, first = np.unique(self.word[chosen], return_index=True)
            out[word] += np.add.reduceat(values[self.row[chosen]] * self.weight[chosen, None], first)
        return out


def _rows_of(numbers: list[np.ndarray], idf: np.ndarray, stride: int = STRIDE) -> Rows | None:
    """The rows of several texts, labelled text * 2^TEXT_SHIFT + passage; passages with few weighted words are left out."""
    rows, found = [], []
    for i, n in enumerate(numbers):
        passage, place = _passage_hits(n, stride)
        rows.append(passage + (i << TEXT_SHIFT))
        found.append(n[place])
    row, word = np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(found or [np.zeros(0, np.int64)])
    if not len(row):
        return None
    made = Rows(row, word, idf, len(idf))
    keep = (made.hits >= MIN_HITS)[made.row]
    if not keep.any():
        return None
    kept = np.repeat(made.label, made.hits)[keep]
    out = Rows(kept, made.word[keep], idf, len(idf))
    out.weight = made.weight[keep]
    return out


class Block:
    """Some items, their words numbered from 1, and what the tasks need of them. Number 0 is any other word."""

    def __init__(self, items: list[Item]) -> None:
        words = sorted({w for item in items for w in (*item.words, *item.answer)})
        self.number = {word: i for i, word in enumerate(words, start=1)}
        self.items = [item.numbered(self.number) for item in items]
        self.kind = "<u2" if len(words) < 1 << 16 else "<u4"
        self.idf = np.ones(len(words) + 1)
        self.counts = np.zeros(len(words) + 1, np.int64)

    def weigh(self, counted: dict[int, int]) -> None:
        """Weights from document frequencies: number of a word -> documents, 0 -> all documents."""
        total = counted.get(0, 0)
        n = np.array([0, *(counted.get(i, 0) for i in range(1, len(self.idf)))])
        self.counts = n
        rare = np.zeros(len(n), bool)
        for item in self.items:
            own = np.array(list(dict.fromkeys(item.words)))
            rare[own[n[own] <= MAX_SHARE * total]] = True
            rare[own[np.argsort(n[own], kind="stable")[:RAREST]]] = True
        self.idf = np.where(rare, np.log((1 + total) / (1 + n)) + 1, 0.0)

    def numbers(self, found: list[bytes]) -> np.ndarray:
        get = self.number.get
        return np.fromiter((get(w, 0) for w in found), self.kind, len(found))

    def weighted(self, numbers: np.ndarray) -> np.ndarray:
        """Numbers of the words that carry weight, -1 for others."""
        return np.where(self.idf[numbers] > 0, numbers.astype(np.int64), -1)


def _numbered(texts: DataFrame, block: Block) -> DataFrame:
    """(doc_id, numbers): every text as the packed numbers of its words."""
    shared = texts.sparkSession.sparkContext.broadcast((block.number, block.kind))
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, kind = shared.value
        get = number.get
        for batch in batches:
            found = [plain_words(text) for text in batch["text"]]
            yield batch[["doc_id"]].assign(numbers=[np.fromiter((get(w, 0) for w in f), kind, len(f)).tobytes() for f in found])

    return texts.mapInPandas(run, f"doc_id {id_type}, numbers binary")


def _frequencies(stored: DataFrame, block: Block) -> dict[int, int]:
    """Number of a word -> texts that have it; 0 -> all texts. A task sends one row per word."""
    size, kind = len(block.idf), block.kind

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            for packed in batch["numbers"]:
                total[np.unique(np.frombuffer(packed, kind))] += 1
            rows += len(batch)
        total[0] = rows
        yield pd.DataFrame({"word": np.arange(size), "n": total})[total > 0]

    counted = stored.select("numbers").mapInPandas(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {row.word: row.n for row in counted.collect()}


def _parts(batch: pd.DataFrame, kind: str, size: int = 1 << 19) -> Iterator[list[np.ndarray]]:
    """The texts of a batch as numbers, some half a million words at a time; a longer text is alone."""
    held: list[np.ndarray] = []
    words = 0
    for packed in batch["numbers"]:
        held.append(np.frombuffer(packed, kind))
        words += len(held[-1])
        if words >= size:
            yield held
            held, words = [], 0
    if held:
        yield held


def _gram_times(stored: DataFrame, block: Block, basis: np.ndarray) -> np.ndarray:
    """A'(A basis) over all passages. A task adds up its rows; equal parts of all tasks are added by key."""
    shared = stored.sparkSession.sparkContext.broadcast((block, basis))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, matrix = shared.value
        total = np.zeros(matrix.shape)
        for batch in batches:
            for part in _parts(batch, own.kind):
                numbers = [own.weighted(n) for n in part]
                rows = _rows_of([n for n in numbers if np.count_nonzero(n >= 0) >= MIN_HITS], own.idf, PASSAGE)
                if rows is not None:
                    total += rows.transposed_times(rows.times(matrix), len(own.idf))
        parts = [(i, total[i : i + MATRIX_ROWS].tobytes()) for i in range(0, len(total), MATRIX_ROWS)]
        yield pd.DataFrame(parts, columns=["part", "sums"])

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in batch.itertuples(index=False):
                values = np.frombuffer(packed)
                sums[part] = sums[part] + values if part in sums else values.copy()
        yield pd.DataFrame([(k, v.tobytes()) for k, v in sums.items()], columns=["part", "sums"])

    schema = "part long, sums binary"
    partial = stored.select("numbers").mapInPandas(run, schema)
    # one matrix at most leaves a task, and each part is added where it meets the others, a row at a time
    rows = partial.repartition("part").mapInPandas(added, schema).collect()
    out = np.zeros(basis.shape)
    for row in rows:
        values = np.frombuffer(row.sums).reshape(-1, basis.shape[1])
        out[row.part : row.part + len(values)] = values
    return out


def randomised_svd(stored: DataFrame, block: Block, own: Rows | None, rank: int = RANK, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors, singular values) of all passages, the benchmark's own (`own`) weighing as much as the rest.

    Subspace iteration from a seeded Gaussian start; each round is one pass over the packed texts.
    """
    width = min(rank + OVERSAMPLED, len(block.idf))
    basis = np.linalg.qr(np.random.default_rng(10).standard_normal((len(block.idf), width)))[0]
    image = basis
    for _ in range(rounds):
        image = _gram_times(stored, block, basis)
        if own is not None:
            part = own.transposed_times(own.times(basis), len(block.idf))
            scale = np.linalg.norm(image) / max(np.linalg.norm(part), 1e-12)
            image = image + part * max(scale, 1.0)
        previous, basis = basis, np.linalg.qr(image)[0]
    # Rayleigh-Ritz on the last image: previous' A'A previous
    small = previous.T @ image
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:rank]
    # the image spans the same space one step further, and has the better vectors
    return basis[:, : len(order)] if len(order) < rank else np.linalg.qr(image @ vectors[:, order])[0], np.sqrt(np.maximum(values[order], 0))


def _near(words: list[int], start: int, size: int, passages: int = 1) -> list[int]:
    """The text around some neighbouring passages, the first at `start`, for an item of `size` words."""
    return words[max(start - size, 0) : start + passages * STRIDE + PASSAGE + size]


class Lookup:
    """Finds by words every text around a passage that the check can take for an item."""

    def __init__(self, block: Block) -> None:
        self.block = block
        self.least = np.zeros(len(block.items), np.int64)
        self.sizes = np.array([len(item.words) for item in block.items])
        postings: list[list[int]] = [[] for _ in block.idf]
        self.answers: dict[int, list[tuple[int, int]]] = {}
        for i, item in enumerate(block.items):
            size = len(item.words)
            number, times = np.unique(item.words, return_counts=True)
            order = np.argsort(block.counts[number], kind="stable")
            spare = size - int(np.ceil(COPIED * size))  # words that a copy may lack
            held = np.cumsum(times[order])
            last = min(int(np.searchsorted(held, spare + LEAST_RARE)), len(held) - 1)
            self.least[i] = held[last] - spare
            for word in number[order[: last + 1]].tolist():
                postings[word].append(i)
            offset = min(range(len(item.answer)), key=lambda k, item=item: block.counts[item.answer[k]])
            self.answers.setdefault(item.answer[offset], []).append((i, offset))
        self.anchor = np.zeros(len(block.idf), bool)
        self.anchor[list(self.answers)] = True
        self.many = np.array([len(p) for p in postings], np.int64)
        self.begin = np.cumsum(self.many) - self.many
        self.items = np.array([i for p in postings for i in p], np.int64)

    def _spans(self, words: list[int], numbers: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, first place, end, needed words): what must stand in the text around a passage, by places of the text."""
        at = np.flatnonzero(self.many[numbers])
        many = self.many[numbers[at]]
        place = np.repeat(at, many)
        within = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
        item = self.items[np.repeat(self.begin[numbers[at]], many) + within]
        # most items have too few places in the whole text
        enough = np.bincount(item, minlength=len(self.least)) >= self.least
        place, item = place[enough[item]], item[enough[item]]
        order = np.argsort(item, kind="stable")
        place, item = place[order], item[order]
        least = self.least[item]
        last = np.arange(len(item)) + least - 1
        last = np.minimum(last, len(item) - 1)
        fits = (np.arange(len(item)) + least <= len(item)) & (item[last] == item)
        fits &= place[last] - place < PASSAGE + STRIDE + 2 * self.sizes[item]
        for i, first, end in zip(item[fits].tolist(), place[fits].tolist(), place[last[fits]].tolist(), strict=True):
            yield i, first, end + 1, int(np.ceil(COPIED * self.sizes[i]))
        for p in np.flatnonzero(self.anchor[numbers]).tolist():
            for i, offset in self.answers[words[p]]:
                answer = self.block.items[i].answer
                if p >= offset and words[p - offset : p - offset + len(answer)] == answer:
                    yield i, p - offset, p - offset + len(answer), int(np.ceil(PARAPHRASED * self.sizes[i]))

    def matches(self, words: list[int], numbers: np.ndarray, known: set[int]) -> Iterator[tuple[int, int, float, bool]]:
        """(item, passage, share, answered) of the first passage that the check takes for an item; `known` items are left out."""
        final = -(-max(len(words) - PASSAGE, 0) // STRIDE)
        wanted: dict[int, dict[int, int]] = {}
        for i, first, end, needed in self._spans(words, numbers):
            if i in known:
                continue
            size = int(self.sizes[i])
            passages = wanted.setdefault(i, {})
            low, high = max(-(-(end - PASSAGE - STRIDE - size) // STRIDE), 0), min((first + size) // STRIDE, final)
            for passage in range(low, high + 1):
                passages[passage] = min(passages.get(passage, needed), needed)
        for i, passages in wanted.items():
            entry, size = self.block.items[i], int(self.sizes[i])
            groups: dict[int, list[int]] = {}
            for passage in sorted(passages):
                groups.setdefault(passage // TOGETHER, []).append(passage)
            for group in groups.values():
                # what all of them hold together bounds what each holds
                wide = _near(words, group[0] * STRIDE, size, group[-1] - group[0] + 1)
                if lcs_length(entry.words, wide) < min(passages[p] for p in group):
                    continue
                found = next(((p, *r) for p in group if (r := entry.check(_near(words, p * STRIDE, size)))[2]), None)
                if found:
                    yield i, found[0], found[1], found[2]
                    break


class Search:
    """What a task needs to search its texts for a block: weights, projection, the block's projected passages."""

    def __init__(self, block: Block, vectors: np.ndarray, own: Rows | None) -> None:
        self.block = block
        self.vectors = vectors.astype(np.float32)
        self.own = _unit(own.times(self.vectors)) if own is not None else np.zeros((0, vectors.shape[1]), np.float32)
        self.item_of = (own.label >> TEXT_SHIFT) if own is not None else np.zeros(0, np.int64)
        self.lookup = Lookup(block)

    def _cosine(self, rows: Rows | None, text: int, passage: int, item: int) -> float:
        """Of a passage and the nearest passage of an item; 0 if either has too few weighted words for a row."""
        own = self.own[self.item_of == item]
        label = (text << TEXT_SHIFT) + passage
        at = int(np.searchsorted(rows.label, label)) if rows is not None else 0
        if rows is None or not len(own) or at == len(rows.label) or rows.label[at] != label:
            return 0.0
        return float((_unit(_part(rows, at, at + 1).times(self.vectors)) @ own.T).max())

    def matches(self, numbers: list[np.ndarray]) -> Iterator[tuple[int, int, float, float, bool]]:
        """(text, item, cosine, share, answered) of the contaminated pairs, the best passage of each."""
        found = [n.tolist() for n in numbers]
        rows = _rows_of([self.block.weighted(n) for n in numbers], self.block.idf)
        best: dict[tuple[int, int], tuple[float, float, bool]] = {}
        if rows is not None and len(self.own):
            for begin in range(0, len(rows.label), 4096):
                part = _part(rows, begin, begin + 4096)
                cosine = _unit(part.times(self.vectors)) @ self.own.T
                at, passage = np.nonzero(cosine >= COSINE)
                for i, j in zip(at.tolist(), passage.tolist(), strict=True):
                    label, item = int(part.label[i]), int(self.item_of[j])
                    text, start = label >> TEXT_SHIFT, (label & ((1 << TEXT_SHIFT) - 1)) * STRIDE
                    entry = self.block.items[item]
                    size = len(entry.words)
                    if (text, item) in best:
                        continue
                    share, answered, bad = entry.check(_near(found[text], start, size))
                    if bad:
                        best[text, item] = (float(cosine[i, j]), share, answered)
        known: dict[int, set[int]] = {}
        for text, item in best:
            known.setdefault(text, set()).add(item)
        for i, words in enumerate(found):
            for j, passage, share, answered in self.lookup.matches(words, numbers[i], known.get(i, set())):
                best[i, j] = (self._cosine(rows, i, passage, j), share, answered)
        for (text, item), values in best.items():
            yield text, self.block.items[item].item_id, *values


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def _part(rows: Rows, begin: int, end: int) -> Rows:
    """Rows begin to end."""
    end = min(end, len(rows.label))
    low, high = rows.begin[begin], rows.begin[end] if end < len(rows.label) else len(rows.word)
    out = object.__new__(Rows)
    out.label, out.hits = rows.label[begin:end], rows.hits[begin:end]
    out.row, out.word, out.weight = rows.row[low:high] - begin, rows.word[low:high], rows.weight[low:high]
    out.begin = rows.begin[begin:end] - low
    return out


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The items in blocks of BLOCK_WORDS words, read partition by partition."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer"))
    items = items.filter("text is not null").groupBy("text", "answer").agg(F.min("item_id").alias("item_id")).orderBy("item_id", "text")
    held: list[Item] = []
    size = 0
    for row in items.toLocalIterator():
        item = Item(row.item_id, row.text, row.answer)
        if not item.words:
            continue
        held.append(item)
        size += len(item.words)
        if size >= BLOCK_WORDS:
            yield Block(held)
            held, size = [], 0
    if held:
        yield Block(held)


def contaminated(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, lcs_share, answered): every document that holds a benchmark item, with the item."""
    spark = documents.sparkSession
    texts = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id long, cosine double, lcs_share double, answered boolean"
    scratch = Scratch(spark, "decontaminate")
    out = spark.createDataFrame([], schema)
    for block in _blocks(benchmark):
        stored = scratch.keep(_numbered(texts, block))
        block.weigh(_frequencies(stored, block))
        own = _rows_of([block.weighted(np.array(item.words, block.kind)) for item in block.items], block.idf)
        vectors, _ = randomised_svd(stored, block, own)
        shared = spark.sparkContext.broadcast(Search(block, vectors, own))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            kind = shared.value.block.kind
            for batch in batches:
                begin = 0
                for part in _parts(batch, kind):
                    rows = [(batch["doc_id"].iloc[begin + i], *rest) for i, *rest in shared.value.matches(part)]
                    yield pd.DataFrame(rows, columns=["doc_id", "item_id", "cosine", "lcs_share", "answered"])
                    begin += len(part)

        out = out.union(stored.mapInPandas(run, schema))
    return out


def clean(documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no benchmark item. A row without an id is kept or dropped with all such rows of its text."""
    # the row as one value, whatever its columns are called
    keyed = documents.select(F.xxhash64(F.col(doc_id), F.col(text)).alias("key"), F.struct("*").alias("row"))
    found = contaminated(keyed.select("key", F.col("row")[text].alias("text")), benchmark, "key", "text")
    return keyed.join(found.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").select("row.*")
