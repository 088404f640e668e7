"""Token-id files: ids of whole texts in the order of ids, coded by the range coder.

A file is a sequence of frames (:mod:`clickweave.llm.range_coder`), then a table of
its documents, then a footer:

    frame ...
    documents: n_tokens as uint64, id as int64, null flag as uint8, column by column
    footer: number of documents, number of ids, crc32 of the table, magic

Files are numbered in the order of document ids; a file's first place in the whole
stream is the number of ids in the files before it.

Texts are encoded by the tokenizers library, in pieces whose ids are remembered. Its
byte-level pattern looks at nothing to the left, so a text may be cut wherever a
pre-token ends in any case:

- before a space that follows a visible character,
- between an ASCII letter and an ASCII character that is none,
- behind a line break between two visible ASCII characters.

Texts that hold a special string are cut before spaces alone, and under any other
normalizer, pre-tokenizer or special string with white space not at all.

Defined results: null and empty texts are the end id alone; null ids come first;
rows with equal ids are ordered by a hash of their text; an empty table writes no
file and reads as no rows; other columns are ignored; document ids are integers.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from clickweave.llm.bpe import shared_definition
from clickweave.llm.common import column, record_batch, texts
from clickweave.llm.files import new_file, open_folder
from clickweave.llm.range_coder import BLOCK_IDS, LANES, pack_frame, unpack_frame
from clickweave.session import materialize, scratch_path, ship_package

FRAME_IDS = BLOCK_IDS * LANES
FOOTER = struct.Struct("<QQI4s")
MAGIC = b"CMTF"
#: Bytes of text that are encoded at once, unless a single text is longer.
SLICE_BYTES = 3 << 23
#: Bytes that are looked through for cuts at once.
MARK_BYTES = 1 << 20
#: Pieces whose ids a worker remembers, and bytes of the longest.
PIECES_KEPT, LONGEST = 1_000_000, 64
#: Pieces that the library is given as one text.
TOGETHER = 2000
#: Before a space: control characters and the spaces beyond ASCII.
UNSURE = re.compile(rb"(?:[\x00-\x1f\x7f]|\xc2[\x80-\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\xaf]"
                    rb"|\xe2\x81\x9f|\xe3\x80\x80) ")
SPACED, BARE = re.compile(rb" [!-~\x80-\xff]+").fullmatch, re.compile(rb"[!-~][!-~\x80-\xff]*").fullmatch
LETTER, SIGN, BREAK, CONTROL, SPACE, HIGH = range(6)
KINDS = bytes(HIGH if b > 127 else SPACE if b == 32 else BREAK if b == 10 else CONTROL if b < 32 or b == 127
              else LETTER if chr(b).isalpha() else SIGN for b in range(256))
ANYWAY, UNLESS_SPECIAL, IF_VISIBLE, IF_SINGLE = 1, 2, 3, 4


def _pair(left: int, right: int) -> int:
    """What is to be done between bytes of two kinds; 0 nothing."""
    if right == SPACE and left in (LETTER, SIGN):
        return ANYWAY
    if right == SPACE and left == HIGH:
        return IF_VISIBLE
    if left == LETTER and right in (SIGN, BREAK, CONTROL):
        return UNLESS_SPECIAL
    return IF_SINGLE if left == BREAK and right in (LETTER, SIGN) else 0


PAIRS = bytes(_pair(p >> 3, p & 7) for p in range(256))


def marks(data: bytes) -> np.ndarray:
    """Of each byte, whether a piece begins there."""
    kinds = np.frombuffer(data.translate(KINDS), np.uint8)
    pairs = np.frombuffer(((kinds[:-1] << 3) | kinds[1:]).tobytes().translate(PAIRS), np.uint8)
    here = np.zeros(len(data), bool)
    here[1:] = (pairs == ANYWAY) | (pairs == UNLESS_SPECIAL)
    held = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(pairs == IF_VISIBLE) + 1
    one, two, three = (held[np.maximum(at - k, 0)] for k in (1, 2, 3))
    here[at] = ~((two == 0xC2) & (one <= 0xA0)
                 | (three == 0xE1) & (two == 0x9A) & (one == 0x80)
                 | (three == 0xE2) & (two == 0x80) & (one <= 0xAF)
                 | (three == 0xE2) & (two == 0x81) & (one == 0x9F)
                 | (three == 0xE3) & (two == 0x80) & (one == 0x80))
    at = np.flatnonzero(pairs == IF_SINGLE) + 1
    here[at] = kinds[np.maximum(at - 2, 0)] <= SIGN
    return here


def cuts(data: bytes, starts: np.ndarray, special: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin that lie one behind the other in ``data``.

    ``starts`` of the texts, ``special``: whether a text holds a special string.
    """
    found = []
    for at in range(0, len(data), MARK_BYTES):
        back = min(at, 3)  # as far as a mark looks back
        found.append((np.flatnonzero(marks(data[at - back:at + MARK_BYTES])[back:]) + at).astype(np.int32))
    found = np.concatenate(found)
    if special.any():
        spaces = np.frombuffer(data, np.uint8)[found] == ord(" ")
        found = found[spaces | ~special[np.searchsorted(starts, found, "right") - 1]]
    at = np.searchsorted(found, starts)
    new = np.append(found, -1)[at] != starts
    return np.insert(found, at[new], starts[new])


def packed(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Ids as little-endian unsigned 16-bit integers, cut at ``ends``."""
    offsets = 2 * np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


class Encoder:
    """Ids of texts; those of pieces are remembered."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        self.library = Tokenizer.from_str(definition)
        if self.library.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids must be below 65,536")
        said = json.loads(definition)
        split, added = said["pre_tokenizer"] or {}, said["added_tokens"]
        self.special = "|".join(re.escape(t["content"]) for t in added)
        self.may_cut = (said["normalizer"] is None and split.get("type") == "ByteLevel"
                        and split.get("use_regex", True) and not split.get("add_prefix_space", True)
                        and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                                    or re.search(r"\s", t["content"]) for t in added))
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.opens, self.breaks = np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)
        self.opens[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True  # a space
        self.breaks[[i for t, i in vocab.items() if t == "\u010a"]] = True  # a line break
        self.known = self.ids = pa.array([], pa.binary())

    def _each(self, pieces: list[str]) -> pa.Array:
        found = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return pa.array([np.array(e.ids, "<u2").tobytes() for e in found], pa.binary())

    def _together(self, pieces: list[str], between: str) -> list[pa.Array]:
        """The same for pieces that begin with their only space, or that a break parts."""
        parts = [pieces[i:i + TOGETHER] for i in range(0, len(pieces), TOGETHER)]
        out = []
        for part in parts:
            found = self.library.encode_batch_fast([between.join(part)], add_special_tokens=False)
            ids = np.array(found[0].ids, "<u2")
            if between:
                ends = np.flatnonzero(self.breaks[ids])
                ids, ends = np.delete(ids, ends), np.append(ends - np.arange(len(ends)), len(ids) - len(ends))
            else:
                ends = np.append(np.flatnonzero(self.opens[ids])[1:], len(ids))
            out.append(packed(ids, ends) if len(ends) == len(part) else self._each(part))
        return out

    def _ids(self, pieces: list[bytes]) -> pa.Array:
        """The library's ids of each piece."""
        groups: tuple[list[int], ...] = ([], [], [])
        for i, p in enumerate(pieces):
            whole = not self.may_cut or (p[-1] > 127 and UNSURE.search(p + b" "))
            groups[2 if whole else 0 if SPACED(p) else 1 if BARE(p) else 2].append(i)
        spaced, bare, rest = ([pieces[i].decode("utf-8", "replace") for i in g] for g in groups)
        found = pa.concat_arrays([*self._together(spaced, ""), *self._together(bare, "\n"), self._each(rest)])
        return found.take(pa.array(np.argsort(np.concatenate(groups).astype(np.int64))))

    def encode(self, data: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one behind the other, number of ids of each text)."""
        data = data.cast(pa.large_binary()).fill_null(b"")
        _, offsets, held = data.buffers()
        offsets = np.frombuffer(offsets, np.int64, len(data) + 1, 8 * data.offset)
        held = bytes(memoryview(held)[offsets[0]:offsets[-1]]) if offsets[-1] > offsets[0] else b""
        if not held:
            return np.zeros(0, "<u2"), np.zeros(len(data), np.int64)
        offsets = offsets - offsets[0]
        full = np.flatnonzero(np.diff(offsets))
        starts = offsets[full]
        if self.may_cut:
            special = np.array([False] * len(full)) if not self.special else pc.match_substring_regex(
                data.take(pa.array(full)), self.special).to_numpy(zero_copy_only=False)
            starts = cuts(held, starts, special)
        bounds = np.append(starts, len(held)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(held)])
        coded = pa.concat_arrays([self.known, pieces]).dictionary_encode()
        n = len(self.known)
        codes, self.known = coded.indices.slice(n), coded.dictionary
        self.ids = pa.concat_arrays([self.ids, self._ids(self.known.slice(n).to_pylist())])
        found = self.ids.take(codes)
        _, ends, ids = found.buffers()
        ends = np.frombuffer(ends, np.int32, len(found) + 1, 4 * found.offset) // 2
        ids = np.frombuffer(ids, "<u2") if ends[-1] else np.zeros(0, "<u2")
        self._forget(codes)
        return ids[ends[0]:ends[-1]], np.diff(ends[np.searchsorted(bounds, offsets)].astype(np.int64))

    def _forget(self, codes: pa.Array) -> None:
        """Lets go of long pieces and, when there are too many, of all but the last ones."""
        keep = pc.binary_length(self.known).to_numpy() <= LONGEST
        if len(self.known) > PIECES_KEPT:
            keep &= np.bincount(codes.to_numpy(), minlength=len(keep)) > 0
            if keep.sum() > PIECES_KEPT:
                keep[:] = False
        if not keep.all():
            self.known, self.ids = self.known.filter(pa.array(keep)), self.ids.filter(pa.array(keep))


@lru_cache(maxsize=2)
def encoder(definition: str) -> Encoder:
    return Encoder(definition)


def by_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows whose texts have SLICE_BYTES in all, or a single longer one."""
    waiting, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(column(batch, "text")), 0).to_numpy(zero_copy_only=False),
                         dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(int(np.searchsorted(ends, before + SLICE_BYTES - size, "right")), at + (not waiting))
            if to > at:
                waiting.append(batch.slice(at, to - at))
                size += int(ends[to - 1]) - before
                at = to
            if at < batch.num_rows or size >= SLICE_BYTES:
                yield pa.Table.from_batches(waiting)
                waiting, size = [], 0
    if waiting:
        yield pa.Table.from_batches(waiting)


def document_table(sizes: np.ndarray, ids: np.ndarray, absent: np.ndarray) -> bytes:
    """The part of a file behind its frames."""
    table = b"".join([sizes.astype("<u8").tobytes(), ids.astype("<i8").tobytes(),
                      absent.astype(np.uint8).tobytes()])
    return table + FOOTER.pack(len(sizes), int(sizes.sum()), zlib.crc32(table), MAGIC)


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files; (number, path, n_docs, n_ids, n_bytes) of each, as a stored table."""
    ship_package(docs.sparkSession)
    definition = shared_definition(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = by_bytes(batches)
        part = next(parts, None)
        if part is None:
            return
        own, number = encoder(definition.value), TaskContext.get().partitionId()
        name = f"tokens-{number:06d}.ids"
        sizes, ids, absent = [], [], []
        with new_file(folder, name) as stream:
            waiting = np.zeros(0, "<u2")
            while part is not None:
                part = part.combine_chunks()
                found, counts = own.encode(part["text"].chunk(0))
                sizes.append(counts + 1)
                own_ids = part["id"].chunk(0)
                absent.append(own_ids.is_null().to_numpy(zero_copy_only=False))
                ids.append(own_ids.cast(pa.int64()).fill_null(0).to_numpy())
                waiting = np.concatenate([waiting, np.insert(found, np.cumsum(counts), end_id)])
                whole = len(waiting) // FRAME_IDS * FRAME_IDS
                for at in range(0, whole, FRAME_IDS):
                    stream.write(pack_frame(waiting[at:at + FRAME_IDS]))
                waiting, part = waiting[whole:].copy(), next(parts, None)
            if len(waiting):
                stream.write(pack_frame(waiting))
            sizes = np.concatenate(sizes)
            stream.write(document_table(sizes, np.concatenate(ids), np.concatenate(absent)))
            size = stream.tell()
        yield record_batch({"number": ([number], pa.int64()),
                            "path": ([f"{folder}/{name}"], pa.string()),
                            "n_docs": ([len(sizes)], pa.int64()),
                            "n_ids": ([int(sizes.sum())], pa.int64()), "n_bytes": ([size], pa.int64())})

    ordered = (texts(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("id", "tie").sortWithinPartitions("id", "tie"))
    return materialize(ordered.mapInArrow(run, "number long, path string, n_docs long, "
                                          "n_ids long, n_bytes long"), "token_files")


def read_file(uri: str) -> Iterator[tuple[list, np.ndarray]]:
    """(documents, ids) frame by frame: documents as (id or None, its ids in all, ids here)."""
    store, path = open_folder(uri)
    with store.open_input_file(path) as stream:
        end = stream.size() - FOOTER.size
        stream.seek(end)
        n, total, want, magic = FOOTER.unpack(stream.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} isn't a token file")
        stream.seek(end - 17 * n)
        table = stream.read(17 * n)
        if zlib.crc32(table) != want:
            raise ValueError(f"the table of {uri} doesn't hold")
        sizes = np.frombuffer(table[:8 * n], "<u8").tolist()
        ids = np.frombuffer(table[8 * n:16 * n], "<i8").tolist()
        absent = np.frombuffer(table[16 * n:], np.uint8).tolist()
        stream.seek(0)
        doc, here, seen = 0, 0, 0
        while seen < total:
            frame = unpack_frame(stream.read)
            seen += len(frame)
            left, parts = len(frame), []
            while left:
                some = min(left, sizes[doc] - here)
                parts.append((None if absent[doc] else ids[doc], sizes[doc], some))
                left, here = left - some, here + some
                if here == sizes[doc]:
                    doc, here = doc + 1, 0
            yield parts, frame


def read_tokens(spark: SparkSession, files: DataFrame, with_ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, ids]) of every document in the files.

    ``start`` is the number of ids before the document in all files; ``ids`` holds
    unsigned 32-bit integers, little-endian, and so does what the crc32 is taken of.
    """
    ship_package(spark)
    totals = files.select("number", "n_ids").toArrow().to_pylist()  # one number per file
    starts, total = {}, 0
    for row in sorted(totals, key=lambda r: r["number"]):
        starts[row["number"]] = total
        total += row["n_ids"]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        id_, start, n, crc, *ids = zip(*rows)
        out = {"id": (list(id_), pa.int64()), "start": (list(start), pa.int64()),
               "n_tokens": (list(n), pa.int64()), "ids_crc32": (list(crc), pa.int64())}
        if with_ids:
            out["ids"] = (list(ids[0]), pa.binary())
        return record_batch(out)

    def documents(path: str, start: int) -> Iterator[tuple]:
        crc, got, kept = 0, 0, []
        for parts, frame in read_file(path):
            data, at = memoryview(frame.astype("<u4").tobytes()), 0
            for id_, n, some in parts:
                piece = data[4 * at:4 * (at + some)]
                crc, got, at = zlib.crc32(piece, crc), got + some, at + some
                if with_ids:
                    kept.append(bytes(piece))
                if got == n:
                    yield (id_, start, n, crc, *([b"".join(kept)] if with_ids else []))
                    start, crc, got, kept = start + n, 0, 0, []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, path in zip(column(batch, "number").to_pylist(),
                                    column(batch, "path").to_pylist()):
                rows, size = [], 0
                for row in documents(path, starts[number]):
                    rows.append(row)
                    size += row[2] if with_ids else 0
                    if len(rows) >= 2000 or size > 1 << 21:
                        yield pack(rows)
                        rows, size = [], 0
                if rows:
                    yield pack(rows)

    schema = "id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    slices = max(1, min(len(totals), 10_000))
    return files.select("number", "path").repartition(slices).mapInArrow(run, schema)


def fresh_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "tokens")
