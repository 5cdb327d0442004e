"""Helpers shared by the training-data operators.

Words are the runs ``[^\\x20\\x09-\\x0D]+`` of a text's UTF-8 bytes, which is
exactly what ``bytes.split()`` yields; ``bytes.lower()`` lower-cases A-Z only.
Text columns are therefore handed to Python as binary.
"""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Distinct words remembered by one Python worker; the memory is emptied (not
# evicted one by one) when it is full, which changes no result.
WORD_MEMORY = 100_000
ROWS_AT_ONCE = 256       # texts of an Arrow batch that are taken apart together
SLICE_BYTES = 4 << 20    # of texts whose words are told apart together
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))
DIGITS = b"0123456789"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Workers find this package where the driver found it, and get texts in batches of 1,000 rows.

    Where the folder is not there (a cluster), the package is installed or
    shipped with the job as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if spark.conf.get(BATCH_ROWS) == "10000":      # Spark's default; a setting of the user's stays
        spark.conf.set(BATCH_ROWS, "1000")
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tickforge-llm-"))
    return sc.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of it.

    Cuts the lineage: what reads it is safe from lost executors and does not
    run the work above it again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def as_binary(col: str = "text"):
    """The text's UTF-8 bytes, a null text as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


def fields(first: str, kind: T.DataType, ddl: str) -> T.StructType:
    """A schema of one column of any name and type, then those of ``ddl``."""
    return T.StructType([T.StructField(first, kind), *T._parse_datatype_string(ddl).fields])


def tidy(run):
    """The task's function; at its end the worker, which Spark keeps for other tasks, gives free memory back."""
    def task(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    return task


SPACE = re.compile(rb"[\x20\x09-\x0D]")
BLOCK_BYTES = 1 << 20    # of a very long text that are taken apart together


def blocks(text: bytes):
    """The text in parts of about BLOCK_BYTES that end before white space, so that no word is cut."""
    at = 0
    while len(text) - at > BLOCK_BYTES:
        space = SPACE.search(text, at + BLOCK_BYTES)
        if not space:
            break
        yield text[at:space.start()]
        at = space.start()
    yield text[at:] if at else text


def slices(batches, rows=ROWS_AT_ONCE):
    """The batches in parts of ROWS_AT_ONCE rows, which bounds the words held at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_slices(batches, column, rows=ROWS_AT_ONCE):
    """Slices of at most ``rows`` rows and SLICE_BYTES of binary text (or one longer text)."""
    for batch in slices(batches, rows):
        end = np.cumsum(pc.binary_length(batch.column(column)).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = end[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(end, before + SLICE_BYTES, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def split_words(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Of binary texts without nulls: each word's place among the distinct ones, these, and the number of words per text."""
    split = pc.ascii_split_whitespace(texts.view(pa.string()))
    found = split.flatten().view(pa.binary()).dictionary_encode()
    codes, ends = found.indices.to_numpy(), np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy())]
    empty = found.dictionary.index(pa.scalar(b"", pa.binary())).as_py()
    if empty < 0:
        sizes = np.diff(ends)
    else:                        # an empty string stands before the first space and after the last
        words = codes != empty
        sizes = np.diff(np.r_[0, np.cumsum(words)][ends])
        codes = codes[words]
    return codes, found.dictionary.to_numpy(zero_copy_only=False).tolist(), sizes


class WordNumbers(dict):
    """word -> small number in order of first sight; exact, no hashing."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def numbers_of(words: list, memory: WordNumbers) -> np.ndarray:
    return np.fromiter(map(memory.__getitem__, words), np.int64, len(words))


def window_keys(ids: np.ndarray) -> np.ndarray:
    """One exact key per 3-word window, from word numbers below 2**21."""
    return (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]


def repeated_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that occur at least twice in the text."""
    if len(ids) < 4:
        return 0
    if ids.max() >= 1 << 21:  # over two million distinct words: renumber within the text
        _, ids = np.unique(ids, return_inverse=True)
        if ids.max() >= 1 << 21:
            _, first = np.unique(ids[:-2] * (int(ids.max()) + 1) + ids[1:-1], return_inverse=True)
            keys = first * (int(ids.max()) + 1) + ids[2:]
        else:
            keys = window_keys(ids)
    else:
        keys = window_keys(ids)
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    if not same.any():
        return 0
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift:shift + len(twice)] |= twice
    return int(covered.sum())


def count_of(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


CONTINUATION = bytes(range(0x80, 0xC0))


def duplicate_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(lines) == 1 or len(set(lines)) == len(lines):
        return 0
    seen, found = set(), 0
    for line in lines:
        if line and line.strip():
            if line in seen:
                found += 1
            else:
                seen.add(line)
    return found


STAT_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "n_lines", "n_distinct_words", "n_upper", "n_letters", "n_digits", "n_bangs")


def text_stats(text: bytes, memory: WordNumbers) -> tuple[int, ...]:
    """The counts of STAT_NAMES over a whole text."""
    words = text.split()
    if len(memory) > WORD_MEMORY:
        memory.clear()
    return stats_of(text, numbers_of(words, memory), len(set(words)))


def stats_of(text: bytes, ids: np.ndarray, n_distinct: int) -> tuple[int, ...]:
    """The counts of STAT_NAMES, from the numbers of the text's words and how many distinct ones there are."""
    chars = len(text) - count_of(text, CONTINUATION)
    upper = count_of(text, UPPER)
    return (len(ids), chars - count_of(text, SPACES), count_of(text, SYMBOLS), duplicate_lines(text),
            repeated_words(ids), text.count(b"\n") + 1, n_distinct, upper,
            count_of(text, LETTERS), count_of(text, DIGITS), text.count(b"!"))
