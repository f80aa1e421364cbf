"""SentencePiece encoding and decoding by vectorised merge rounds.

All words of a batch are merged together. Their characters stand in one flat array of symbols; a round finds in
every word the pair of lowest rank, merges its occurrences from the left, and compacts the arrays; a word leaves
when it has no pair left. A word is cut beforehand where two characters stand together in no piece, as no merge can
cross such a place; so texts without spaces fall into short words too.

Only models of kind BPE with identity normalisation are taken; others raise ValueError.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import claim, map_batches, strings

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
NONE = np.iinfo(np.int32).max
#: Words whose ids a Python worker remembers; at that number it forgets all of them.
MOST_WORDS = 400_000


class PieceModel:
    """Pieces, ranks of pairs and byte pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, train = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        if (train.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces or train.treat_whitespace_as_suffix or BYTE not in kinds
                or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}):
            raise ValueError("a BPE model with byte pieces, identity normalisation and no own symbols is needed")
        self.prefix = norm.add_dummy_prefix
        self.end = next((i for i, p in enumerate(proto.pieces) if p.piece == train.eos_piece), -1)
        self.size = len(proto.pieces)
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.byte_id = np.zeros(256, np.int32)
        self.raw: list[bytes] = [b""] * self.size
        self.is_byte = np.zeros(self.size, bool)
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_id[value], self.raw[i], self.is_byte[i] = i, bytes([value]), True
            elif p.type == NORMAL:
                self.raw[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == UNKNOWN:
                self.raw[i] = train.unk_surface.encode()
        self.starts_blank = np.array([r.startswith(b" ") for r in self.raw]) & ~self.is_byte
        # Symbols: ids of pieces, and one more for each character that stands only inside pieces.
        symbol = dict(normal)
        for piece in normal:
            for c in piece:
                symbol.setdefault(c, self.size + len(symbol))
        self.char = np.full(0x110000, -1, np.int32)
        for s, i in symbol.items():
            if len(s) == 1:
                self.char[ord(s)] = i
        rank = {s: r for r, s in enumerate(sorted({proto.pieces[i].score for i in normal.values()}, reverse=True))}
        self.span = 2 * self.size + len(symbol) + 2
        rows, beside = [], set()
        for piece, i in normal.items():
            beside.update(zip(piece, piece[1:], strict=False))
            for cut in range(1, len(piece)):
                a, b = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if a is not None and b is not None:
                    rows.append((a * self.span + b, rank[proto.pieces[i].score], i))
        rows.sort()
        self.key = np.array([r[0] for r in rows], np.int64)
        self.rank = np.array([r[1] for r in rows], np.int32)
        self.to = np.array([r[2] for r in rows], np.int32)
        self.beside = np.array(sorted(ord(a) << 21 | ord(b) for a, b in beside), np.int64)
        self.line_alone = not any("\n" in p for p in normal)
        self.known: dict[str, bytes] = {}

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each pair; rank NONE where there is none."""
        key = left.astype(np.int64) * self.span + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        there = self.key[at] == key
        return np.where(there, self.rank[at], NONE), self.to[at]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols left after all merges, the place of their first character, and the code points of the words."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(w) for w in words])
        final = np.full(len(points), -2, np.int32)
        sym, place = self.char[points], np.arange(len(points))
        wide = points.astype(np.int64)
        beside = wide[:-1] << 21 | wide[1:]
        at = np.minimum(np.searchsorted(self.beside, beside), len(self.beside) - 1)
        last = np.ones(len(points), bool)  # the last symbol of its word
        last[:-1] = self.beside[at] != beside
        last[ends[:-1] - 1] = True
        rank, to = np.full(len(points), NONE, np.int32), np.zeros(len(points), np.int32)
        inner = np.flatnonzero(~last)
        rank[inner], to[inner] = self.pairs(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.concatenate(([True], last[:-1])))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(sym)))
            if (lowest == NONE).any():  # words that are done leave
                out = np.repeat(lowest == NONE, sizes)
                final[place[out]] = sym[out]
                stay = ~out
                sym, place, last, rank, to = sym[stay], place[stay], last[stay], rank[stay], to[stay]
                lowest, sizes = lowest[lowest != NONE], sizes[lowest != NONE]
                if not len(sym):
                    break
            word = np.repeat(np.arange(len(sizes)), sizes)
            hit = np.flatnonzero(rank == lowest[word])
            run = np.arange(len(hit))  # of touching occurrences, every second one, from the left
            head = np.concatenate(([True], (np.diff(hit) != 1) | (word[hit[1:]] != word[hit[:-1]])))
            run -= np.maximum.accumulate(np.where(head, run, 0))
            hit = hit[run % 2 == 0]
            first = np.concatenate(([True], word[hit[1:]] != word[hit[:-1]]))
            several = np.zeros(len(sizes), bool)
            several[word[hit[~first]]] = True
            if several.any():  # a new pair of lower rank would come first: such words merge one occurrence only
                many = several[word[hit]]
                p = hit[many]
                after = np.minimum(p + 2, len(sym) - 1)
                right, _ = self.pairs(to[p], sym[after])
                right[last[p + 1]] = NONE
                before = np.maximum(p - 1, 0)
                left_sym = sym[before].copy()
                joined = np.isin(p - 2, p)
                left_sym[joined] = to[p[joined] - 2]
                left, _ = self.pairs(left_sym, to[p])
                left[(p == 0) | last[before]] = NONE
                bad = np.zeros(len(sizes), bool)
                bad[word[p[np.minimum(left, right) < lowest[word[p]]]]] = True
                hit = hit[first | ~bad[word[hit]]]
            sym[hit] = to[hit]
            last[hit] = last[hit + 1]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            now = np.cumsum(stay)[hit] - 1
            sym, place, last, rank, to = sym[stay], place[stay], last[stay], rank[stay], to[stay]
            mark = np.zeros(len(sym), bool)
            mark[now], mark[now[now > 0] - 1] = True, True
            rank[mark] = NONE
            change = np.flatnonzero(mark & ~last)
            rank[change], to[change] = self.pairs(sym[change], sym[change + 1])
        left = np.flatnonzero(final != -2)
        return final[left], left, points

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian int32; characters without a piece become bytes."""
        sym, place, points = self.merged(words)
        ends = np.cumsum([len(w) for w in words])
        lost = (sym < 0) | (sym >= self.size)
        c = points[place].astype(np.int64)
        n_bytes = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        width = np.where(lost, n_bytes, 1)
        to = np.cumsum(width) - width
        ids = np.empty(int(width.sum()), np.int32)
        ids[to[~lost]] = sym[~lost]
        c, n_bytes, to = c[lost], n_bytes[lost], to[lost]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
        for k in range(4):
            m = n_bytes > k
            shift = 6 * (n_bytes[m] - 1 - k)
            value = (c[m] >> shift) & np.where(k == 0, 0xFF, 0x3F)
            value = value | (lead[n_bytes[m]] if k == 0 else 0x80)
            ids[to[m] + k] = self.byte_id[value & 0xFF]
        word = np.searchsorted(ends, place, side="right")
        bounds = np.concatenate(([0], np.cumsum(np.bincount(word, weights=width, minlength=len(words))))).astype(int)
        raw = ids.tobytes()
        return [raw[4 * a: 4 * b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def words(self, text: str) -> list[str]:
        """The text cut where no merge can cross: before blanks, and around line ends if no piece holds one."""
        if not text:
            return []
        if self.prefix:
            text = " " + text
        text = text.replace(SPACE, " ")
        out: list[str] = []
        for k, line in enumerate(text.split("\n") if self.line_alone else [text]):
            if k:
                out.append("\n")
            head, *parts = line.split(" ")
            if head:
                out.append(head)
            if "" in parts:  # runs of blanks stay with the word they lead
                blanks = 0
                for p in parts:
                    blanks += 1
                    if p:
                        out.append(SPACE * blanks + p)
                        blanks = 0
                if blanks:
                    out.append(SPACE * blanks)
            else:
                out.extend([SPACE + p for p in parts])
        return out

    def encode(self, texts: list[str], end: bool = False) -> list[np.ndarray]:
        """The ids of each text."""
        claim("pieces", self.known.clear)
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        cut = [self.words(t) for t in texts]
        new = list({w for ws in cut for w in ws if w not in self.known})
        if new:
            self.known.update(zip(new, self.encode_words(new), strict=True))
        tail = np.int32(self.end).tobytes() if end else b""
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, ws)) + tail, np.int32) for ws in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: bytes that are not UTF-8 become U+FFFD each, control ids nothing."""
        ids = np.asarray(ids, np.int32)
        ids = ids[[len(self.raw[i]) > 0 for i in ids.tolist()]] if len(ids) else ids
        parts = [self.raw[i] for i in ids.tolist()]
        if parts and self.prefix and self.starts_blank[ids[0]]:
            parts[0] = parts[0][1:]
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            pass
        out, run = [], b""
        for i, raw in zip(ids.tolist(), parts, strict=True):
            if self.is_byte[i]:
                run += raw
            else:
                out += [_lenient(run), raw.decode()]
                run = b""
        return "".join([*out, _lenient(run)])


def _lenient(raw: bytes) -> str:
    """UTF-8 with U+FFFD for each single byte that starts no valid character."""
    out, i = [], 0
    while i < len(raw):
        n = 1 if raw[i] < 0x80 else 2 if raw[i] >> 5 == 6 else 3 if raw[i] >> 4 == 14 else 4
        try:
            out.append(raw[i: i + n].decode())
            i += n
        except UnicodeDecodeError:
            out.append("�")
            i += 1
    return "".join(out)


@lru_cache(maxsize=4)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
           end: bool = True) -> DataFrame:
    """Columns ``keep`` and ``ids`` (array<int>): the ids of each whole text, with an end id if asked for.

    A null or empty text has only the end id (or none). Repeated rows stay, each with its ids; a null key stays null.
    Other columns are not read, whatever their names. No shuffle: texts are encoded where they are read.
    """
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        ids = model(path).encode(strings(batch, text), end)
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))]

    return map_batches(docs.select(*keep, text), run, "ids array<int>", list(keep))


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """Columns ``keep`` and ``decoded``: the text of the ids; null or no ids give the empty text."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        rows = batch.column(batch.schema.get_field_index(ids))
        m = model(path)
        return [pa.array([m.decode(r.values.to_numpy(zero_copy_only=False) if r.is_valid else ()) for r in rows],
                         pa.string())]

    return map_batches(encoded.select(*dict.fromkeys([*keep, ids])), run, "decoded string", list(keep))
