"""Unigram encoding over a double-array trie of pieces, with byte fallback, and decoding.

Pieces and scores come from a SentencePiece model file. A model of byte-pair merges stores ranks instead of log
probabilities; its pieces then get Zipf's law, ``-log(rank + 1)``, as their log scores.

The whitespace marker of the pieces is read as a blank, so a text needs no rewriting: a blank is put before it, a piece
``marker + word`` matches `` word``, and a marker that stands in the text itself has no piece and goes through bytes.
Encoding is the Viterbi path of highest total score over all pieces that match; a character without a piece of its own
may also be spelled in bytes, at a score below every piece. Equal totals go to the longer last piece. Decoding joins
the pieces, bytes included, and drops the first blank, so every text comes back byte by byte.

As no piece goes on after a blank (but those of blanks only) or across a line break, the path falls apart at these
places. A worker remembers the ids of the parts; those seen for the first time are solved side by side, a step of the
trie for all of them at once.

Defined results: a null or empty text has no ids and decodes to the empty text; malformed UTF-8 goes through bytes one
at a time; repeated rows are kept; extra columns are left out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketry.llm.common import input_columns, of_worker, per_batch, table, texts_of, utf8

MARKER = "▁"
#: how far below the lowest piece a character spelled in bytes scores
FALLBACK_PENALTY = 10.0
#: most parts whose ids a worker remembers
REMEMBERED = 200_000
#: texts whose parts a worker holds at a time
TEXTS = 512
#: longer parts are solved one by one
SIDE_BY_SIDE = 64

_PART = re.compile(rb" *[^ \n]+|\n| +")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class DoubleArray:
    """A trie of byte strings: ``base[s] + byte`` is the next state if ``check`` of it is ``s``."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in keys.items():
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    values.append(-1)
                node = children[node][byte]
            values[node] = value
        size = 4 * len(children) + 1024
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        taken = bytearray(size)
        taken[0] = 1
        state_of, free = {0: 0}, 1
        order = [0]
        for node in order:
            edges = children[node]
            state = state_of[node]
            self.value[state] = values[node]
            if not edges:
                continue
            low = min(edges)
            # dense stretches are left behind, so that the search for a fit stays short
            while taken[free]:
                free += 1
            start, tries = free, 0
            while any(taken[start - low + byte] for byte in edges) or start < low:
                start += 1
                tries += 1
            if tries > 200:
                free += 1
            base = start - low
            self.base[state] = base
            for byte, child in edges.items():
                taken[base + byte] = 1
                self.check[base + byte] = state
                state_of[child] = base + byte
                order.append(child)

    def prefixes(self, text: bytes, at: int) -> list[tuple[int, int]]:
        """Ends and values of the keys that start at a position."""
        found, state = [], 0
        base, check, value = self.base, self.check, self.value
        for end in range(at, len(text)):
            step = int(base[state]) + text[end]
            if check[step] != state:
                break
            state = step
            if value[state] >= 0:
                found.append((end + 1, int(value[state])))
        return found


def char_lengths(data: np.ndarray) -> np.ndarray:
    """Bytes of the character that starts at each byte, by its first byte; a stray byte counts as one."""
    return np.where(data < 0xC0, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))


def well_formed(text: bytes) -> bool:
    try:
        text.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


class Unigram:
    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], remembered: int = REMEMBERED):
        """``pieces`` with the marker; control and byte pieces are given as empty strings. ``byte_ids``: by byte."""
        keys = {piece.replace(MARKER, " ").encode(): number for number, piece in enumerate(pieces) if piece}
        if any((b" " in key[1:] and key.strip(b" ")) or b"\n" in key for key in keys):
            raise ValueError("a piece goes on after a blank or holds a line break")
        self.trie = DoubleArray(keys)
        self.longest = max(map(len, keys))
        self.scores = np.asarray(scores, np.float64)
        used = [scores[number] for number in keys.values()]
        self.fallback = min(used) - FALLBACK_PENALTY
        self.single = {key for key in keys if len(key) <= 4 and well_formed(key) and len(key.decode()) == 1}
        self.byte_ids = byte_ids
        self.bytes_of = [piece.replace(MARKER, " ").encode() for piece in pieces]
        for byte, number in enumerate(byte_ids):
            self.bytes_of[number] = bytes([byte])
        self.remembered = remembered
        self.known: dict[bytes, bytes] = {}
        # a character of one byte without a piece is looked up by byte
        self.bare = np.array([bytes([byte]) not in self.single for byte in range(256)])

    def _steps(self, part: bytes) -> list[int]:
        """Length of the character at each byte if it may be spelled in bytes, else 0."""
        lengths = [0] * len(part)
        at, whole = 0, well_formed(part)
        while at < len(part):
            size = 1 if part[at] < 0x80 or not whole else 2 if part[at] < 0xE0 else 3 if part[at] < 0xF0 else 4
            if part[at : at + size] not in self.single:
                lengths[at] = size
            at += size
        return lengths

    def _one(self, part: bytes) -> list[int]:
        n = len(part)
        best, came = [-np.inf] * (n + 1), [(-1, -1)] * (n + 1)
        best[0] = 0.0
        spelled = self._steps(part)
        for at in range(n):
            here = best[at]
            if here == -np.inf:
                continue
            for end, piece in self.trie.prefixes(part, at):
                if here + self.scores[piece] > best[end]:
                    best[end], came[end] = here + self.scores[piece], (at, piece)
            if spelled[at] and here + self.fallback > best[at + spelled[at]]:
                best[at + spelled[at]], came[at + spelled[at]] = here + self.fallback, (at, -1)
        return self._path(part, lambda end: came[end])

    def _path(self, part: bytes, came) -> list[int]:
        ids, end = [], len(part)
        while end:
            at, piece = came(end)
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.byte_ids[byte] for byte in reversed(part[at:end]))
            end = at
        return ids[::-1]

    def _many(self, parts: list[bytes]) -> list[list[int]]:
        """Viterbi over parts of similar length, one step of the trie for all at once."""
        count, width = len(parts), max(map(len, parts))
        data = np.zeros((count, width), np.int64)
        for row, part in enumerate(parts):
            data[row, : len(part)] = np.frombuffer(part, np.uint8)
        sizes = np.fromiter(map(len, parts), np.int64, count)
        spelled = np.zeros((count, width), np.int64)
        ascii_only = (data < 0x80).all(axis=1)
        spelled[ascii_only] = self.bare[data[ascii_only]]
        for row in np.flatnonzero(~ascii_only):
            spelled[row, : sizes[row]] = self._steps(parts[row])
        best = np.full((count, width + 5), -np.inf)
        best[:, 0] = 0.0
        came_at, came_piece = np.zeros((count, width + 5), np.int64), np.full((count, width + 5), -1, np.int64)
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for at in range(width):
            rows = np.flatnonzero((sizes > at) & (best[:, at] > -np.inf))
            if not len(rows):
                continue
            lone = rows[spelled[rows, at] > 0]
            if len(lone):
                ends = at + spelled[lone, at]
                score = best[lone, at] + self.fallback
                better = score > best[lone, ends]
                lone, ends = lone[better], ends[better]
                best[lone, ends], came_at[lone, ends], came_piece[lone, ends] = score[better], at, -1
            state = np.zeros(len(rows), np.int64)
            for end in range(at, min(width, at + self.longest)):
                inside = sizes[rows] > end
                rows, state = rows[inside], state[inside]
                step = base[state] + data[rows, end]
                fits = check[step] == state
                rows, state = rows[fits], step[fits]
                if not len(rows):
                    break
                piece = value[state]
                is_piece = piece >= 0
                ended, piece = rows[is_piece], piece[is_piece]
                score = best[ended, at] + self.scores[piece]
                better = score > best[ended, end + 1]
                ended = ended[better]
                best[ended, end + 1], came_at[ended, end + 1] = score[better], at
                came_piece[ended, end + 1] = piece[better]
        out = []
        for row, part in enumerate(parts):
            ats, pieces = came_at[row].tolist(), came_piece[row].tolist()
            out.append(self._path(part, lambda end, ats=ats, pieces=pieces: (ats[end], pieces[end])))
        return out

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > self.remembered:
            self.known.clear()
        split = [_PART.findall(b" " + text) if text else [] for text in texts]
        fresh: set[bytes] = set()
        for parts in split:
            fresh.update(parts)
        fresh -= self.known.keys()
        order = sorted(fresh, key=len)
        short = [part for part in order if len(part) <= SIDE_BY_SIDE]
        for at in range(0, len(short), 8192):
            some = short[at : at + 8192]
            for part, ids in zip(some, self._many(some), strict=True):
                self.known[part] = np.array(ids, "<i4").tobytes()
        for part in order[len(short) :]:
            self.known[part] = np.array(self._one(part), "<i4").tobytes()
        known = self.known.__getitem__
        out = [np.frombuffer(b"".join(map(known, parts)), "<i4") for parts in split]
        for part in order[len(short) :]:  # long parts hardly ever come back
            del self.known[part]
        return out

    def rest(self) -> None:
        """Forget what is remembered: workers that wait would each hold it."""
        self.known.clear()

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))[1:]


def unigram(model_file: str, zipf: bool = True) -> Unigram:
    """The encoder of a model file, once per worker. ``zipf``: the file's scores are ranks."""
    return of_worker(("pieces", model_file, zipf), lambda: _unigram(model_file, zipf))


def _unigram(model_file: str, zipf: bool) -> Unigram:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, scores, byte_ids = [], [], [-1] * 256
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number)
        byte = _BYTE_PIECE.fullmatch(piece)
        if byte and model.is_byte(number):
            byte_ids[int(byte[1], 16)] = number
        special = model.is_byte(number) or model.is_control(number) or model.is_unknown(number) or model.is_unused(number)
        pieces.append("" if special else piece)
        score = model.get_score(number)
        scores.append(-float(np.log(1 + max(0.0, min(-score, 1e6)))) if zipf else score)
    if min(byte_ids) < 0:
        raise ValueError("the model has no byte pieces to fall back on")
    return Unigram(pieces, scores, byte_ids)


def encode(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text", zipf: bool = True) -> DataFrame:
    """A row per document: its ids, their number, and whether decoding them gives the text again."""
    rows = input_columns(docs, doc_id=doc_id, body=text)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = unigram(model_file, zipf)
        texts = texts_of(batch.column("body"))
        ids = model.encode(texts)
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "ids": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), flat),
                "n_tokens": pa.array(sizes, pa.int64()),
                "round_trip": pa.array([model.decode(some) == text for some, text in zip(ids, texts, strict=True)]),
            }
        )

    schema = f"doc_id {kind}, ids array<int>, n_tokens long, round_trip boolean"
    return per_batch(rows.select("doc_id", utf8("body").alias("body")), run, schema, TEXTS)


def decode(encoded: DataFrame, model_file: str, doc_id: str = "doc_id", ids: str = "ids", zipf: bool = True) -> DataFrame:
    """The texts of id lists; a null list decodes to the empty text."""
    rows = input_columns(encoded, doc_id=doc_id, ids=ids)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = unigram(model_file, zipf)
        texts = [model.decode(np.asarray(some or [], np.int32)).decode("utf-8", "replace") for some in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return per_batch(rows, run, f"doc_id {kind}, text string")


def op5(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
