"""Token counts with a shortcut for whole tokens.

A byte-level vocabulary is read from the JSON file of its library. Before any text is
seen, every string of the vocabulary is merged on the driver; those that end as their own
single token are proven to count as one wherever a pre-token equals them. A text is cut
at special strings, each of which counts as one token, and the rest into pre-tokens.
Pre-tokens with the proof are counted directly; only the others are merged, by the order of the
merges, leftmost first, and remembered while a task runs. Nothing is shuffled, and what is
sent to the workers depends on the vocabulary alone.

Cases: a missing or empty text has no bytes and no tokens; repeated rows are counted each;
a text or a pre-token of any length is counted whole; an empty table gives an empty result;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepline.llm.text import blocks, whole

LIMIT = 1024
_KNOWN = 400_000  # merged pre-tokens remembered in a task
_SHORT = 64  # bytes of a pre-token worth remembering


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    return [others.get(b, chr(b)) for b in range(256)]


def newer_characters(path: str) -> str:
    """Letters and numbers of the pattern engine that the library's older Unicode tables do not know."""
    from tokenizers import Tokenizer

    unassigned = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    candidates = regex.findall(r"[\p{L}\p{N}]", unassigned)
    # After a mark, a letter or number is a piece of its own; anything else stays with the mark.
    pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str("".join(f" !{c}" for c in candidates))
    return "".join(candidates[start // 3] for _, (start, end) in pieces if end - start == 3)


def ranges(characters: str) -> str:
    """The inside of a character class that holds these, in ascending order."""
    codes = [ord(c) for c in characters]
    first = [c for i, c in enumerate(codes) if not i or codes[i - 1] != c - 1]
    last = [c for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first, last))


@dataclass
class Counter:
    """Merges, the strings proven to be one token, and special strings of one vocabulary."""

    merges: dict[tuple[int, int], tuple[int, int]]  # pair of ids -> (rank, id)
    byte_ids: list[int]
    specials: list[str]
    pattern: str
    newer: str
    alone: frozenset[str] = field(default=frozenset())

    def prepare(self) -> None:
        self._known: dict[str, int] = {}
        self._cut = regex.compile(self.pattern)
        self._newer = frozenset(self.newer)
        self._special = regex.compile("|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))) if self.specials else None

    @cached_property
    def _strict(self) -> regex.Pattern:
        """The pattern with the newer characters outside its classes of letters and numbers."""
        newer = ranges(self.newer)
        strict = self.pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{newer}])")
        for kind in ("L", "N"):
            strict = strict.replace(rf"\p{{{kind}}}+", rf"(?:(?![{newer}])\p{{{kind}}})+")
        return regex.compile(strict)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.prepare()

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one pre-token after all merges, least rank first, leftmost of equals."""
        ids = [self.byte_ids[b] for b in piece]
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(*found, i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := self.merges.get((ids[i], ids[i + 1])))]
        heap = [(rank, i, new, a, b) for rank, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (found := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (found[0], left, found[1], ids[left], ids[right]))
        return [x for x in ids if x >= 0]

    def length(self, piece: str) -> int:
        """Tokens of a pre-token that has no proof."""
        found = self._known.get(piece)
        if found is None:
            raw = piece.encode()
            found = len(self.merged(raw))
            if len(raw) <= _SHORT:
                if len(self._known) >= _KNOWN:
                    self._known.clear()
                self._known[piece] = found
        return found

    def count(self, text: str) -> tuple[int, int]:
        """Tokens of a text, and how many of them were counted without merging."""
        parts = self._special.split(text) if self._special else [text]
        tokens = direct = len(parts) - 1
        cut = self._cut if text.isascii() or self._newer.isdisjoint(text) else self._strict
        for part in parts:
            pieces = cut.findall(part)
            rest = [p for p in pieces if p not in self.alone]
            direct += len(pieces) - len(rest)
            tokens += len(pieces) - len(rest) + sum(map(self.length, rest))
        return tokens, direct


def load_counter(path: str, pattern: str) -> Counter:
    """Read the vocabulary and prove which of its strings encode alone as one token."""
    with open(path, encoding="utf-8") as file:
        state = json.load(file)
    model, cutter = state["model"], state["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and cutter.get("use_regex")
    if not plain or any(state[k] for k in ("normalizer", "truncation", "padding")) or model.get("ignore_merges"):
        raise ValueError(f"{path} is not a plain byte-level vocabulary")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in state["added_tokens"]):
        raise ValueError(f"{path} has added tokens that take their surroundings with them")
    vocabulary, shown = model["vocab"], byte_characters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)}
    counter = Counter(merges, [vocabulary[c] for c in shown], [t["content"] for t in state["added_tokens"]], pattern, newer_characters(path))
    counter.prepare()
    byte_of, alone = {c: b for b, c in enumerate(shown)}, set()
    for token, number in vocabulary.items():
        raw = bytes(byte_of[c] for c in token)
        if counter.merged(raw) == [number]:
            try:
                alone.add(raw.decode())
            except UnicodeDecodeError:
                pass  # parts of characters are never pre-tokens
    counter.alone = frozenset(alone)
    return counter


def count_tokens(docs: DataFrame, counter: Counter, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, n_direct`` of every row."""
    rows = docs.select(F.col(doc_id).alias("__id"), whole(text).alias("__text")).withColumn("n_bytes", F.octet_length("__text").cast("bigint"))
    sent = docs.sparkSession.sparkContext.broadcast(counter)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks(batches, "__text"):
            found = [sent.value.count(t) for t in block["__text"]]
            yield block[["__id", "n_bytes"]].assign(n_tokens=[n for n, _ in found], n_direct=[d for _, d in found])

    kind = rows.schema["__id"].dataType.simpleString()
    counted = rows.mapInPandas(run, f"__id {kind}, n_bytes bigint, n_tokens bigint, n_direct bigint")
    return counted.select(F.col("__id").alias(doc_id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_direct")
