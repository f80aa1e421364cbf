"""Token counts by heap-and-linked-list byte-pair merging, without making identifiers.

The symbols of a word stand in a doubly linked list; a heap holds its adjacent pairs by (rank, place). The lowest is
popped and, if both sides are still as they were when it was pushed, merged; the two new pairs are pushed. The count
is the number of first symbols less the number of merges.

The rules around the merges (normalisers, words, byte alphabet, word end, special strings) are read from the
tokenizer file; what isn't covered raises ValueError.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import cached_property, lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, map_batches, strings

#: Pieces of text and words whose counts a Python worker remembers; at that number it forgets all of them.
MOST_WORDS = 600_000
#: Tokens above which a document counts as over the limit.
LIMIT = 2048


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


class Counter:
    """Counts of one tokenizer file of kind BPE with words cut by a pattern and a byte alphabet."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, normal = spec["model"], spec["normalizer"]
        before = spec["pre_tokenizer"]["pretokenizers"] if spec["pre_tokenizer"]["type"] == "Sequence" else []
        kinds = [n["type"] for n in (normal or {}).get("normalizers", [])]
        if (model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges")
                or model.get("continuing_subword_prefix") or kinds != ["NFC", "Replace", "Lowercase"]
                or [p["type"] for p in before] != ["Split", "ByteLevel"] or before[0]["behavior"] != "Removed"
                or not before[0]["invert"] or before[1]["add_prefix_space"] or before[1]["use_regex"]):
            raise ValueError("a BPE tokenizer with NFC, lower case, kept pattern matches and bytes is needed")
        self.word = regex.compile(before[0]["pattern"]["Regex"])
        special = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special strings with conditions are not covered")
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.special_chars = "<" if all(s.startswith("<") for s in special) else ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(a, b): r for r, (a, b) in enumerate(merges)}
        self.alphabet = byte_alphabet()
        self.value = {c: b for b, c in enumerate(self.alphabet)}
        self.path = path
        self.end = model.get("end_of_word_suffix") or ""
        self.known: dict[str, int] = {}
        self.words: dict[str, int] = {}

    @cached_property
    def rules(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def merged(self, word: str) -> int:
        """Tokens of one word, given in the byte alphabet."""
        symbols = list(word)
        if len(symbols) == 1:
            return 1
        symbols[-1] += self.end
        rank, n = self.rank, len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, i + 1, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False))
                if (r := rank.get((a, b))) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if after[i] != j or symbols[i] != a or symbols[j] != b:
                continue  # one side has been merged since
            merges += 1
            symbols[i], symbols[j] = a + b, ""
            k = after[i] = after[j]
            after[j] = -2
            if k >= 0:
                before[k] = i
                if (r := rank.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i, k, symbols[i], symbols[k]))
            h = before[i]
            if h >= 0 and (r := rank.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h, i, symbols[h], symbols[i]))
        return n - merges

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if text.isascii() or max(text) < "\u0250":
            text = unicodedata.normalize("NFC", text).lower()
            cut = self.word.findall(text)
        else:  # beyond Latin letters, classes and cases hang on the library's Unicode version
            cut = [self.text_of(w) for w, _ in self.rules.pre_tokenizer.pre_tokenize_str(
                self.rules.normalizer.normalize_str(text))]
        words, total = self.words, 0
        for w in cut:
            n = words.get(w)
            if n is None:
                n = words[w] = self.merged("".join([self.alphabet[b] for b in w.encode()]))
            total += n
        return total

    def text_of(self, word: str) -> str:
        return bytes(map(self.value.__getitem__, word)).decode()

    def forget(self) -> None:
        self.known.clear()
        self.words.clear()

    def part(self, part: str) -> int:
        """Tokens of a text without blanks and line ends; special strings count one each."""
        if self.special and self.special_chars in part:
            plain = self.special.split(part)
            return len(plain) - 1 + sum(map(self.plain, plain))
        return self.plain(part)

    def count(self, text: str) -> int:
        """Tokens of a text. Words never reach over blanks or line ends, so the parts between are counted once each."""
        claim("counts", self.forget)
        if len(self.known) > MOST_WORDS or len(self.words) > MOST_WORDS:
            self.forget()
        known, total = self.known, 0
        for p in text.replace("\n", " ").split(" "):
            n = known.get(p)
            if n is None:
                n = known[p] = self.part(p)
            total += n
        return total


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 limit: int = LIMIT) -> DataFrame:
    """Columns ``keep``, ``n_bytes`` (UTF-8), ``n_tokens``, and ``over_limit`` (more than ``limit`` tokens).

    A null or empty text has 0 bytes and 0 tokens. Repeated rows stay; a null key stays null; other columns are not
    read. No shuffle, and memory is bounded by one batch and the remembered counts.
    """
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = strings(batch, text)
        c = counter(path)
        return [pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array([c.count(t) for t in texts], pa.int64())]

    counted = map_batches(docs.select(*keep, text), run, "n_bytes long, n_tokens long", list(keep))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
