"""BPE encoding through a table of distinct words, and decoding through an id-to-piece join.

A word here is a run without ASCII white space. The tokenizer's normaliser and splitter never look across such white
space and drop it, so the ids of a text are the ids of its words, one after the other. The vocabulary file is a
parameter; each distinct word is encoded once, whatever its number of places.

1. The words of a bounded sample of documents (`SAMPLE`) are counted; the `frequent` most frequent of at most
   `FREQUENT_CHARS` characters, and the `FREQUENT_LONG` most frequent longer ones up to `LONG_CHARS`, are encoded and
   broadcast. This part of the word table only saves work: hot words never meet in a shuffle. Results are the same
   whatever it holds.
2. All other words of all texts go, once per text, to the task that holds the word; there each distinct one is encoded
   once, and its ids go back to the text with the word's place among the text's own. Texts that are the same are
   answered once.
3. Texts are not shuffled: they travel as compressed codes of their words.
4. Ids are put together by position, then decoded: piece = pieces[id], joined by a space, as the tokenizer's
   decode does without a decoder. Words without ids, such as a lone no-break space, have no piece either.

Ids travel in 2 bytes where the vocabulary allows it.

Defined results: null and blank texts have no ids and decode to the empty text. Repeated rows, null and repeated ids
give a row each; an empty table gives none. Texts of any length are taken whole. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samedays.llm.common import words

FREQUENT = 400_000
FREQUENT_CHARS = 64
FREQUENT_LONG, LONG_CHARS = 200, 1 << 16
#: Documents from which the frequent words are taken.
SAMPLE = 60_000
#: Words that the tokenizer gets at once.
ENCODE_BATCH = 5_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: A place from here on takes 4 bytes more.
_LONG = 0xFFFF


def pieces_of(path: str) -> list[str | None]:
    """The piece of each id, by position: the right side of the decoding join. Bounded by the vocabulary."""
    tokenizer = _tokenizer(path)
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    pieces: list[str | None] = [None] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        pieces[number] = piece
    return pieces


def distinct_words(documents: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): every distinct word with its number of places."""
    return documents.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def encode_words(distinct: DataFrame, path: str) -> DataFrame:
    """(word, ids) for rows of distinct words: ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(ids=_encoded(batch["word"].tolist(), path))

    return distinct.select("word").mapInPandas(run, "word string, ids binary")


def _encoded(found: list[str], path: str) -> list[bytes]:
    tokenizer, out = _tokenizer(path), []
    for begin in range(0, len(found), ENCODE_BATCH):
        encoded = tokenizer.encode_batch_fast(found[begin : begin + ENCODE_BATCH], add_special_tokens=False)
        out += [np.asarray(e.ids, "<u4").tobytes() for e in encoded]
    return out


def decode(rows: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with the decoded text of packed ids: ids are joined with the broadcast table id -> piece by position."""
    pieces = rows.sparkSession.sparkContext.broadcast(pieces_of(path))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != to) + f", `{to}` string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.array(pieces.value, dtype=object)
        for batch in batches:
            yield batch.assign(**{to: [" ".join(table[np.frombuffer(b or b"", "<u4")]) for b in batch[ids]]})

    return rows.drop(to).mapInPandas(run, schema)


def frequent_words(documents: DataFrame, path: str, text: str, most: int, sample: int = SAMPLE) -> list[tuple[str, bytes]]:
    """(word, ids) of the most frequent words of a sample of the documents: a bounded number of bounded words."""
    rows = documents.count()
    chosen = documents if rows <= sample else documents.sample(fraction=sample / rows, seed=2)
    counted = distinct_words(chosen, text)
    short = counted.filter(F.length("word") <= FREQUENT_CHARS).orderBy(F.desc("n"), "word").limit(most)
    long = counted.filter(F.length("word").between(FREQUENT_CHARS + 1, LONG_CHARS) & (F.col("n") > 1))
    top = short.union(long.orderBy(F.desc("n"), "word").limit(min(most, FREQUENT_LONG)))
    return list(zip(*(column.to_pylist() for column in encode_words(top, path).toArrow().columns), strict=True))


def answer_words(places: DataFrame, path: str, kind: str) -> DataFrame:
    """Rows (key, place, word) as (key, answer); all places of a word meet, and it is encoded once.

    An answer is the place in 2 bytes, or in 4 behind 2 bytes of ones, and the ids.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple[str, bytes] = ("", b"")
        before: tuple | None = None
        for batch in batches:
            # rows come sorted by word and text; what the same text asked before needs no second answer
            first = ~batch.duplicated(["word", "key"]).to_numpy()
            if len(batch):
                first[0] &= tuple(batch.iloc[0][["word", "key"]]) != before
                before = tuple(batch.iloc[-1][["word", "key"]])
            batch = batch[first]
            # the last word of a batch may go on in the next
            number, distinct = pd.factorize(batch["word"])
            fresh = [w for w in distinct if w != last[0]]
            ids = dict(zip(fresh, (np.frombuffer(b, "<u4").astype(kind).tobytes() for b in _encoded(fresh, path)), strict=True))
            ids[last[0]] = last[1]
            table = [ids[w] for w in distinct]
            last = (distinct[-1], table[-1]) if len(distinct) else last
            answers = [
                (p.to_bytes(2, "little") if p < _LONG else b"\xff\xff" + p.to_bytes(4, "little")) + table[n]
                for p, n in zip(batch["place"].tolist(), number.tolist(), strict=True)
            ]
            yield batch[["key"]].assign(answer=answers)

    dealt = places.repartition("word").sortWithinPartitions("word", "key")
    return dealt.mapInPandas(run, "`key` long, answer binary")


def keyed_texts(source: DataFrame, make: Callable[[int], Column] = lambda seed: F.xxhash64("doc_id", "text", F.lit(seed))) -> DataFrame:
    """The rows with a `key` of 64 bits that only rows of the same text share.

    Texts are told apart by 96 bits, of which the rows of their words carry 64: of two texts with one key, 32 bits more
    differ, and then another seed is taken. One row per text is grouped for that.
    """
    for seed in count():
        keyed = source.withColumn("key", make(seed))
        found = keyed.groupBy("key").agg(F.min(F.hash("text")).alias("low"), F.max(F.hash("text")).alias("high"))
        if found.where("low <> high").isEmpty():
            return keyed


def _answers(answers: np.ndarray, kind: str) -> dict[int, np.ndarray]:
    """Ids of a text's own words by their places."""
    out = {}
    for answer in answers:
        place, begin = int.from_bytes(answer[:2], "little"), 2
        if place == _LONG:
            place, begin = int.from_bytes(answer[2:6], "little"), 6
        out[place] = np.frombuffer(answer, kind, -1, begin)
    return out


def _planes(numbers: list[int]) -> bytes:
    """Numbers as bytes, those of the same weight next to each other, which compresses them."""
    return np.array(numbers, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


class Spans:
    """Ids of many words in one array, and the gathering of those of a list of words."""

    def __init__(self, words: list[bytes], kind: str) -> None:
        found = [np.frombuffer(ids, "<u4").astype(kind) for ids in words]
        self.size = np.array([len(f) for f in found], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.ids = np.concatenate(found) if found else np.zeros(0, kind)

    def gather(self, numbers: np.ndarray, own: dict[int, np.ndarray]) -> np.ndarray:
        """Ids of the words with these numbers, one word after the other; numbers beyond the list are of `own` words."""
        base = len(self.size)
        rare = np.flatnonzero(numbers >= base)
        known = np.where(numbers < base, numbers, 0) if len(rare) else numbers
        if not base:
            return np.concatenate([own[n] for n in numbers.tolist()] or [self.ids])
        size, begin = self.size[known], self.begin[known]
        if len(rare):
            found = [own[n - base] for n in numbers[rare].tolist()]
            size[rare] = [len(f) for f in found]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(begin - (ends - size), size)
        if len(rare):
            # their places are filled in afterwards
            inside = np.zeros(len(numbers), bool)
            inside[rare] = True
            hole = np.repeat(inside, size)
            at[hole] = 0
            out = self.ids[at] if len(self.ids) else np.zeros(total, found[0].dtype)
            out[hole] = np.concatenate(found)
            return out
        return self.ids[at]


def encode(
    documents: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
    digests: bool = False,
) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every document; with `digests`, sha256 of the ids and of the text instead."""
    spark = documents.sparkSession
    source = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    known = frequent_words(source, path, "text", frequent)
    pieces = spark.sparkContext.broadcast(pieces_of(path))
    kind = "<u2" if len(pieces.value) <= 1 << 16 else "<u4"
    # in two parts, each without an object per word: a task needs the words or their ids
    known_words = spark.sparkContext.broadcast(b" ".join(word.encode() for word, _ in known))
    known_ids = spark.sparkContext.broadcast(Spans([ids for _, ids in known], kind))
    id_type = source.schema["doc_id"].dataType.simpleString()
    keyed = keyed_texts(source)

    def code_table() -> dict[bytes, int]:
        return {word: i for i, word in enumerate(known_words.value.split())}

    def rare_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = code_table()
        for batch in batches:
            rare = [list({w: None for w in t.encode().split() if w not in codes}) for t in batch["text"]]
            many = [len(r) for r in rare]
            at = np.repeat(np.arange(len(batch)), many)
            found = batch[["key"]].iloc[at].reset_index(drop=True)
            place = np.concatenate([np.arange(n) for n in many] or [np.zeros(0, int)])
            yield found.assign(place=place, word=pd.Series([w.decode() for r in rare for w in r], dtype=object))

    def coded(codes: dict[bytes, int], text: str) -> list[int]:
        """The number of each word: its code, or from the number of codes on, its place among the text's own words."""
        found = text.encode().split()
        rare: dict[bytes, int] = {}
        base = len(codes)
        return [codes[w] if w in codes else rare[w] if w in rare else rare.setdefault(w, base + len(rare)) for w in found]

    def skeletons(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = code_table()
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield batch[["doc_id", "key"]].assign(codes=[packer.compress(_planes(coded(codes, t))) for t in batch["text"]])

    # a word of a text once, numbered by its first place there, as `coded` numbers them
    places = keyed.mapInPandas(rare_words, "`key` long, place int, word string")
    # dealt as plain rows: lists of the one or two answers that a task has for a text are larger on disk than the answers
    answers = answer_words(places, path, kind).repartition("key")
    by_text = answers.groupBy("key").agg(F.collect_list("answer").alias("answers"))
    bones = keyed.mapInPandas(skeletons, f"doc_id {id_type}, `key` long, codes binary")
    joined = bones.join(by_text, "key", "left").select("doc_id", "codes", "answers")

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.array(pieces.value, dtype=object)
        words = known_ids.value
        unpacker = zstandard.ZstdDecompressor()
        names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "ids", "decoded"]
        for batch in batches:
            rows = []
            for packed, answers in zip(batch["codes"], batch["answers"], strict=True):
                planes = np.frombuffer(unpacker.decompress(packed), np.uint8).reshape(4, -1)
                numbers = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
                found = words.gather(numbers, {} if answers is None else _answers(answers, kind))
                # words without ids have no piece, and leave no blank
                decoded = " ".join(table[found].tolist())
                ids = found.astype("<u4").tobytes()
                if digests:
                    rows.append((len(found), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
                else:
                    rows.append((len(found), ids, decoded))
            yield pd.concat([batch[["doc_id"]], pd.DataFrame(rows, columns=names, index=batch.index)], axis=1)

    if digests:
        return joined.mapInPandas(whole, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return joined.mapInPandas(whole, f"doc_id {id_type}, n_tokens long, ids binary, decoded string")
