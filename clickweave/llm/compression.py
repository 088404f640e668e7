"""Quality rules by compression bands.

A text that zstandard shrinks far more than prose repeats itself; one that it
can't shrink is noise. What is usual depends on the length, because the
compressor needs some text before it finds anything to refer to. So the bands
are given per length, and apply to the whole document and to its fixed chunks.
The upper limits lie between prose and random words, which shrink to 0.67 or more
at any length. Short texts in characters of several bytes shrink as little as
noise (Chinese 0.81 at 1 KB, 0.66 at 4 KB; random ideographs 0.75 and 0.70), so
they have upper limits of their own, which tell noise from 4 KB on.

Defined results: null and empty texts have no words and fail the base rule; a
null id is carried; repeated rows are judged each on its own; other columns are
ignored by :func:`compression_rules` and kept by :func:`keep_documents`.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from clickweave.llm.common import column, map_batches, record_batch, sliced, texts, utf8, worker_memo
from clickweave.session import ship_package

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
ABOVE_ASCII = bytes(range(0x80, 0x100))
MIN_WORDS = 50
REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Bands:
    """(bytes from which the band holds, lowest ratio, highest ratio), by length."""

    limits: tuple[tuple[int, float, float], ...] = (
        (0, 0.30, 8.00),
        (64, 0.30, 1.30),
        (192, 0.30, 0.91),
        (256, 0.30, 0.85),
        (384, 0.30, 0.80),
        (512, 0.30, 0.76),
        (768, 0.30, 0.72),
        (1_024, 0.25, 0.70),
        (4_096, 0.20, 0.66),
        (16_384, 0.15, 0.64),
        (65_536, 0.12, 0.64),
    )
    #: (bytes, highest ratio) where a quarter of the bytes or more isn't ASCII.
    wide: tuple[tuple[int, float], ...] = (
        (0, 8.00),
        (64, 1.30),
        (256, 1.05),
        (384, 0.98),
        (512, 0.92),
        (640, 0.88),
        (1_024, 0.83),
        (1_536, 0.78),
        (2_048, 0.74),
        (4_096, 0.69),
        (8_192, 0.67),
        (65_536, 0.66),
    )
    chunk_bytes: int = 4_096
    bad_share: float = 0.30  # of the bytes, in chunks outside their band
    level: int = 3

    def holds(self, text: bytes, packed: int) -> bool:
        """Is this a usual ratio for this length? Nothing is said about empty input."""
        size = len(text)
        if size == 0:
            return True
        low, high = next((lo, hi) for n, lo, hi in reversed(self.limits) if size >= n)
        if not low <= packed / size:
            return False
        if packed / size > high and 4 * (size - len(text.translate(None, ABOVE_ASCII))) >= size:
            high = next(hi for n, hi in reversed(self.wide) if size >= n)
        return packed / size <= high


COLUMNS = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"),
           ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("base_failed", "boolean"),
           ("ratio", "double"), ("n_chunks", "long"), ("bad_chunks", "long"),
           ("kept", "boolean"))
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three which the text has more than once."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times, covered, end = Counter(windows), 0, 0
    for start, window in enumerate(windows):
        if times[window] > 1:
            covered += start + 3 - max(start, end)
            end = start + 3
    return covered


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    characters = len(text.decode("utf-8", "replace"))
    white = len(text) - len(text.translate(None, SPACE))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return (len(words), characters - white, symbols, len(lines) - len(set(lines)),
            repeated_words(words))


def judge(text: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple:
    """The values of :data:`COLUMNS` for one text."""
    base = base_counts(text)
    failed = base[0] < MIN_WORDS or 100 * base[4] > REPEAT_PERCENT * base[0]
    packed = len(packer.compress(text))
    chunks = bad = bad_bytes = 0
    for start in range(0, len(text), bands.chunk_bytes):
        chunk = text[start:start + bands.chunk_bytes]
        outside = not bands.holds(chunk, len(packer.compress(chunk)))
        chunks, bad, bad_bytes = chunks + 1, bad + outside, bad_bytes + outside * len(chunk)
    good = bands.holds(text, packed) and bad_bytes <= bands.bad_share * len(text)
    ratio = packed / len(text) if text else None
    return (*base, failed, ratio, chunks, bad, good and not failed)


def compression_rules(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(id_col, the columns of COLUMNS): counts, ratios and the verdict ``kept``."""
    kind = dict(docs.dtypes)[id_col]

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        packer = zstandard.ZstdCompressor(level=bands.level)
        rows = [judge(t, bands, packer) for t in utf8(batch)]
        values = zip(*rows)
        ids = column(batch, "id")
        return record_batch({id_col: (ids, ids.type)}
                            | {name: (list(v), _ARROW[t]) for (name, t), v in zip(COLUMNS, values)})

    schema = f"`{id_col}` {kind}, " + ", ".join(f"{n} {t}" for n, t in COLUMNS)
    return map_batches(texts(docs, id_col, text_col), make, schema)


def keep_documents(docs: DataFrame, bands: Bands = Bands(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text passes; no shuffle."""
    ship_package(docs.sparkSession)

    def run(batches):
        packer = worker_memo(("zstd", bands.level),
                             lambda: zstandard.ZstdCompressor(level=bands.level))
        for batch in sliced(batches):
            passed = [judge(t, bands, packer)[-1] for t in utf8(batch, text_col)]
            yield batch.filter(pa.array(passed, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
