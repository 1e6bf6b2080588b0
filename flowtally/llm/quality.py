"""Quality rules by compression bands.

A text whose zstandard ratio (compressed bytes by bytes) is too low repeats itself, and one
whose ratio is too high is noise. Short texts compress worse, so each length has limits of
its own. The same limits hold for fixed chunks, which finds a repetitive or random stretch
inside a text that looks sound as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVEL = 3
CHUNK = 4096
#: A text is rejected if chunks outside their band hold more than this share of its bytes.
BAD_SHARE = 0.1
#: Up to so many bytes: lowest and highest ratio of a sound text. Frames of a few bytes say little.
#: The highest ratios of 250,000 texts of invented prose are 0.78 up to 512 bytes, then 0.72, 0.62,
#: 0.56, 0.51, 0.47, 0.45 and 0.41; each limit is three to eight per cent above.
BANDS = [
    (64, 0.0, 9.0), (256, 0.35, 1.20), (512, 0.30, 0.84), (1024, 0.30, 0.75), (2048, 0.25, 0.65), (4096, 0.25, 0.58),
    (8192, 0.20, 0.54), (16384, 0.20, 0.50), (65536, 0.12, 0.47), (None, 0.12, 0.44),
]
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def band(size: int) -> tuple[float, float]:
    return next((low, high) for most, low, high in BANDS if most is None or size <= most)


def compression(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, float, str]:
    """Ratio of the whole text, share of bytes in chunks outside their band, and the verdict."""
    if not data:
        return 0.0, 0.0, "ok"
    ratio = len(compressor.compress(data)) / len(data)
    bad = 0
    if len(data) > CHUNK:
        for start in range(0, len(data), CHUNK):
            chunk = data[start : start + CHUNK]
            low, high = band(len(chunk))
            if not low <= len(compressor.compress(chunk)) / len(chunk) <= high:
                bad += len(chunk)
    low, high = band(len(data))
    verdict = "repetitive" if ratio < low else "incompressible" if ratio > high else "ok"
    if verdict == "ok" and bad > BAD_SHARE * len(data):
        verdict = "uneven"
    return ratio, bad / len(data), verdict


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three words that occurs at least twice."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    _, pair = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    found = np.zeros(len(words), bool)
    again = np.flatnonzero(count[window] > 1)
    for k in range(3):
        found[again + k] = True
    return int(found.sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def measures(text: bytes | None, compressor: zstandard.ZstdCompressor) -> tuple:
    data = text or b""
    codes = np.frombuffer(data, np.uint8)
    words = data.split()  # at ASCII white space only, for bytes
    points = int(((codes & 0xC0) != 0x80).sum()) - int(_BLANK[codes].sum())
    repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * len(words)
    ratio, bad_share, verdict = compression(data, compressor)
    return (
        len(words), points, int(_SYMBOL[codes].sum()), duplicate_lines(data), repeat,
        failed, not failed and verdict == "ok", ratio, bad_share, verdict,
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "bad_share", "verdict"]
TYPES = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2 + [pa.string()]
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, ratio double, bad_share double, verdict string"
)


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        rows = [measures(text.as_py(), compressor) for text in batch.column("text")]
        columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(TYPES)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *NAMES])


def quality(docs: DataFrame) -> DataFrame:
    """Measures and verdict of every row: ``kept`` unless a base rule or a band rejects it.

    NULL and empty texts have no words and fail the base rule; repeated rows are judged each;
    an empty table gives no rows; other columns are not read. Rows are independent, and a
    task holds a batch of them at a time.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(_measure_batches, SCHEMA)
