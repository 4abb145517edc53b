"""What the operators of this subpackage share: reading tables, cutting lineage, words of a text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samedays.functions.shared import delete_at_exit, shared_folder

#: White space and words as every contract of this subpackage has them (ASCII white space only).
WHITE = " \t\n\x0b\f\r"
WHITE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE_CLASS + "+"), "")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def made_once(frame: DataFrame, **columns: Column) -> DataFrame:
    """The frame with more columns, each made once per row.

    A later filter on a plain column is moved below its projection and makes the column again, once for every
    reference in the chain. It does not pass a generator, so the columns come from a generator of one row.
    """
    return frame.select("*", F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))


class Scratch:
    """Tables written in the shared folder to cut lineage: they outlive the executors that wrote them, not the session."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, frame: DataFrame) -> DataFrame:
        """The same rows, read from a table just written."""
        self.count += 1
        path = f"{self.folder}/{self.count}"
        frame.write.parquet(path)
        if self.count == 1:
            delete_at_exit(self.spark, self.folder)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *numbers: int) -> None:
        """Delete tables that nothing reads any more, by their number in the order of keep()."""
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for number in numbers:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{number}")
            path.getFileSystem(conf).delete(path, True)


#: ASCII letters in lower case and digits as they are, other ASCII characters as spaces, bytes beyond ASCII as they are.
_PLAIN = bytes(b if chr(b).isalnum() else 32 for b in range(128)).lower() + bytes(range(128, 256))


def plain_words(text: str | None) -> list[bytes]:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of a text with A-Z in lower case."""
    return (text or "").encode().translate(_PLAIN).split()


def document_frequencies(texts: DataFrame, numbers: Mapping[bytes, int]) -> DataFrame:
    """(word, n): in how many rows of `text` each numbered word stands; word -1 counts the rows.

    `numbers` gives each word of a bounded vocabulary its number from 0. A task sends one row per word.
    """
    shared = texts.sparkSession.sparkContext.broadcast(dict(numbers))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        total = np.zeros(len(known) + 1, np.int64)
        for batch in batches:
            for text in batch["text"]:
                total[[known[w] for w in known.keys() & set(plain_words(text))]] += 1
            total[-1] += len(batch)
        number = np.append(np.arange(len(known)), -1)
        yield pd.DataFrame({"word": number, "n": total})[total > 0]

    return texts.select("text").mapInPandas(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
