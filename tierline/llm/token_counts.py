"""Exact token counts of every prefix of a text, for byte-level BPE vocabularies.

The library's encoder merges pairs until none is left. The same segmentation can be
found from left to right: the encoding of a prefix is the encoding of a shorter prefix
plus one token, and the right token is the only one whose boundary to the token before
it no merge would cross. So one pass over a piece of text (a word, say) gives the token
count of each of its prefixes, and the counts of a text follow by adding up its pieces.
Nothing is encoded again to answer "how many tokens has the first k characters" or
"how much of this text fits into n tokens".
"""

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate, batched
from operator import sub

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from tierline.llm.common import python_tasks

#: Fixed value: the split that byte-level vocabularies of this family are made for.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _units(space: str, letter: str, number: str) -> str:
    words = "'s|'t|'re|'ve|'m|'ll|'d"
    rest = rf"[{letter}]+|[{number}]+|[^{space}{letter}{number}]+"
    return rf"[{space}]+(?:(?<! )(?:{words})|{rest})?|{words}|{rest}"


#: The same split with white space and the piece after it in one unit: the counts of a
#: unit's prefixes do not depend on what is around it.
UNITS = _units(r"\s", r"\p{L}", r"\p{N}")


def _latin(kind: str) -> str:
    """The code points below 256 of a kind, as the split knows it, for a class of ``re``."""
    return "".join(re.escape(c) for c in map(chr, range(256)) if regex.match(kind, c))


#: The same units of texts without other code points, for ``re``: it is twice as fast.
LATIN_UNITS = _units(*map(_latin, (r"\s", r"\p{L}", r"\p{N}")))

#: Pieces whose counts a worker remembers before it starts afresh.
MEMO_PIECES = 1_000_000

#: Units longer than this are counted each time they come.
MEMO_LENGTH = 64

#: Texts longer than this are split piece by piece instead of into one list.
LONG_TEXT = 2_000_000

_NEVER = 1 << 60


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the vocabulary file: visible ones for themselves,
    the others for the code points from 256 on, in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


_BLANK = regex.compile(r"\s*")


def _blanks(text: str) -> int:
    """White space that a text starts with, as the split knows it (str.isspace knows more)."""
    return _BLANK.match(text).end()


def _one_piece(unit: str) -> bool:
    """Whether the prefixes of a unit are each one piece, as the unit itself is."""
    blank = _blanks(unit)
    return blank == len(unit) or not (unit[0] == "'" and len(unit) == 3) and (blank == 0 or blank == 1 and unit[0] == " ")


def _narrow(counts: list[int]) -> bytes:
    """Counts as steps of one byte; an OverflowError if a step does not fit."""
    return array("b", map(sub, counts, [0, *counts])).tobytes()


class _UnitSteps(dict):
    """Steps of the prefix counts of units, one byte a code point."""

    def __init__(self, counter: "PrefixCounter"):
        super().__init__()
        self.counter = counter

    def learn(self, units: set[str]) -> None:
        """Count new units; those that are one piece in sorted order, so that each starts
        from the prefix it shares with the one before."""
        new = [u for u in units if len(u) <= MEMO_LENGTH and u not in self]
        if len(self) + len(new) > MEMO_PIECES:
            self.clear()
            new = [u for u in units if len(u) <= MEMO_LENGTH]
        counts, last, before = [0], [-1], b""
        for raw, unit in sorted((u.encode(), u) for u in new if _one_piece(u)):
            shared = next((k for k, (x, y) in enumerate(zip(raw, before)) if x != y), min(len(raw), len(before)))
            del counts[shared + 1 :], last[shared + 1 :]
            self.counter._extend(raw, counts, last)
            at = counts[1:] if len(raw) == len(unit) else [counts[k] for k in accumulate(len(c.encode()) for c in unit)]
            try:
                self[unit] = _narrow(at)
            except OverflowError:
                pass
            before = raw

    def __missing__(self, unit: str) -> bytes:
        steps = _narrow(self.counter._unit_counts(unit))
        if len(unit) <= MEMO_LENGTH:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[unit] = steps
        return steps


def _refuse_unknown(spec: dict) -> None:
    """Raise for a file whose settings would give other counts than are found here."""
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    unknown = [name for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(name)]
    if model.get("type", "BPE") != "BPE":
        unknown.append("model")
    if spec.get("normalizer"):
        unknown.append("normalizer")
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or split.get("use_regex") is False:
        unknown.append("pre_tokenizer")
    unknown += [f"added token {t['content']}" for t in spec.get("added_tokens", []) if any(t.get(name) for name in ("single_word", "lstrip", "rstrip", "normalized"))]
    if unknown:
        raise ValueError(f"not a plain byte-level BPE file: {', '.join(unknown)}")


class PrefixCounter(dict):
    """Counts of a vocabulary; as a dict, it maps pieces to the tokens of the whole piece."""

    def __init__(self, vocabulary: bytes):
        super().__init__()
        spec = json.loads(vocabulary)
        _refuse_unknown(spec)
        letter = _byte_letters()
        raw = {text: bytes(letter[c] for c in text) for text in spec["model"]["vocab"] if all(c in letter for c in text)}
        self.tokens = {raw[text]: i for text, i in spec["model"]["vocab"].items() if text in raw}
        # The tokens spelled backwards as a tree: steps by node and byte, tokens by node.
        self.steps: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for raw_token, i in self.tokens.items():
            node = 0
            for byte in reversed(raw_token):
                node = self.steps.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = i
        self.rank, made = {}, {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = self.tokens[raw[left]], self.tokens[raw[right]]
            self.rank[a, b] = rank
            made.setdefault(self.tokens[raw[left] + raw[right]], (a, b, rank))
        self.made = made
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.kept: dict[int, bool] = {}
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.added = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        self.split = regex.compile(SPLIT)
        self.unit = regex.compile(UNITS)
        self.latin_unit = re.compile(LATIN_UNITS)
        self.units = _UnitSteps(self)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one edge (0 left, 1 right) while ``token`` is built, with the rank
        of the merge that makes each; from the single byte up."""
        chain = self.edges.get((token, side))
        if chain is None:
            parts = self.made.get(token)
            chain = [(token, -1)] if parts is None else [*self._edge(parts[side], side), (token, parts[2])]
            self.edges[token, side] = chain
        return chain

    def _keeps(self, left: int, right: int) -> bool:
        """Whether the boundary between two adjacent tokens survives all merges.

        Both sides are built side by side in the order of ranks. At any time one pair
        touches at the boundary; it is merged, and the boundary lost, if its rank comes
        before the next merge of either side (of equal ranks the leftmost goes first).
        """
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            next_a = a[i + 1][1] if i + 1 < len(a) else _NEVER
            next_b = b[j + 1][1] if j + 1 < len(b) else _NEVER
            rank = self.rank.get((a[i][0], b[j][0]))
            if rank is not None and rank < next_a and rank <= next_b:
                found = False
                break
            if next_a == next_b == _NEVER:
                found = True
                break
            if next_a <= next_b:
                i += 1
            else:
                j += 1
        if len(self.kept) >= 1_000_000:
            self.kept.clear()
        self.kept[left << 32 | right] = found
        return found

    def _extend(self, piece: bytes, counts: list[int], last: list[int]) -> None:
        """Fill in the token count and the last token of each prefix of ``piece`` beyond
        those already there."""
        step, ends, kept = self.steps.get, self.ends, self.kept
        for end in range(len(counts), len(piece) + 1):
            node, at = 0, end
            while at:
                node = step(node << 8 | piece[at - 1])
                if node is None:
                    break
                at -= 1
                token = ends[node]
                if token < 0:
                    continue
                if at:
                    fits = kept.get(last[at] << 32 | token)
                    if fits is None:
                        fits = self._keeps(last[at], token)
                    if not fits:
                        continue
                counts.append(counts[at] + 1)
                last.append(token)
                break

    def byte_counts(self, piece: bytes) -> list[int]:
        """Token counts of the prefixes of a piece: item k for its first k bytes."""
        counts = [0]
        self._extend(piece, counts, [-1])
        return counts

    def learn(self, pieces: set[str]) -> None:
        """Count new pieces in sorted order, so that each starts from the prefix it shares
        with the one before."""
        new = sorted((piece.encode(), piece) for piece in pieces if piece not in self)
        if len(self) + len(new) > MEMO_PIECES:
            self.clear()
        counts, last, before = [0], [-1], b""
        for raw, piece in new:
            shared = next((k for k, (x, y) in enumerate(zip(raw, before)) if x != y), min(len(raw), len(before)))
            del counts[shared + 1 :], last[shared + 1 :]
            self._extend(raw, counts, last)
            self[piece] = counts[-1]
            before = raw

    def __missing__(self, piece: str) -> int:
        if len(self) >= MEMO_PIECES:
            self.clear()
        self[piece] = n = self.byte_counts(piece.encode())[-1]
        return n

    def _parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text cut at the strings of added tokens; True marks such a string."""
        at = 0
        for found in self.added.finditer(text) if self.added else ():
            yield text[at : found.start()], False
            yield found.group(), True
            at = found.end()
        yield text[at:], False

    def totals(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts."""
        split = []
        for text in texts:
            parts = list(self._parts(text))
            added = sum(is_added for _, is_added in parts)
            pieces = [[] if is_added else self.split.findall(part) for part, is_added in parts] if len(text) <= LONG_TEXT else None
            split.append((text, parts, added, pieces))
        self.learn(set().union(*(part for _, _, _, pieces in split if pieces for part in pieces)))
        out = []
        for _, parts, added, pieces in split:
            if pieces is None:
                found = (self[m.group()] for part, is_added in parts if not is_added for m in self.split.finditer(part))
            else:
                found = (sum(map(self.__getitem__, p)) for p, (_, is_added) in zip(pieces, parts, strict=True) if not is_added)
            out.append(added + sum(found))
        return out

    def _piece_counts(self, piece: str) -> list[int]:
        """Token counts of a piece's prefixes by code points, without the empty one.

        A shortened ``'re`` is no contraction but two pieces.
        """
        by_byte = self.byte_counts(piece.encode())
        counts = [by_byte[k] for k in accumulate(len(c.encode()) for c in piece)]
        if len(piece) == 3 and piece[0] == "'" and piece[1].isalpha():
            counts[1] = self[piece[0]] + self[piece[1]]
        return counts

    def _unit_counts(self, unit: str) -> list[int]:
        """Token counts of a unit's prefixes by code points, without the empty one."""
        out: list[int] = []
        done, run = 0, ""
        for piece in self.split.findall(unit):
            blank = _blanks(piece)
            if blank:
                # White space at the end of a prefix is one piece, however it is split later.
                was, run = len(run), run + piece[:blank]
                by_byte = self.byte_counts(run.encode())
                ends = list(accumulate(len(c.encode()) for c in run))
                out += [by_byte[k] for k in ends[was:]]
            if blank < len(piece):
                out += [done + n for n in self._piece_counts(piece)[blank:]]
            done += self[piece]
        return out

    def _joined(self, units: Iterable[str]) -> np.ndarray:
        units = list(units)
        try:
            return np.frombuffer(b"".join(map(self.units.__getitem__, units)), dtype=np.int8)
        except OverflowError:
            return np.concatenate([np.diff(self._unit_counts(u), prepend=0) for u in units]).astype(np.int32)

    def _units_of(self, part: str) -> list[str]:
        try:
            part.encode("latin-1")
        except UnicodeEncodeError:
            return self.unit.findall(part)
        return self.latin_unit.findall(part)

    def _cut(self, text: str) -> list[tuple[str, bool, list[str] | None]]:
        """The parts of a text with their units, if the text is not too long to hold them."""
        return [(part, added, self._units_of(part) if not added and len(text) <= LONG_TEXT else None) for part, added in self._parts(text)]

    def _part_steps(self, part: str, units: list[str] | None) -> np.ndarray:
        if units is not None:
            return self._joined(units)
        return np.concatenate([self._joined(some) for some in batched((m.group() for m in self.unit.finditer(part)), 1 << 16)])

    def prefix_steps(self, text: str) -> np.ndarray:
        """Item k is by how much the token count grows from the first k code points to
        the first k + 1, each prefix encoded on its own."""
        return self._cut_steps(self._cut(text))

    def _cut_steps(self, cut: list[tuple[str, bool, list[str] | None]]) -> np.ndarray:
        out = []
        total, before = 0, ""
        for part, added, units in cut:
            if added:
                # Cut short, the string of an added token is text like any other.
                pieces = self.split.findall(before)
                tail = "".join(pieces[-2:])
                start = total - sum(map(self.__getitem__, pieces[-2:]))
                counts = [total, *(start + sum(map(self.__getitem__, self.split.findall(tail + part[:k]))) for k in range(1, len(part))), total + 1]
                out.append(np.diff(counts).astype(np.int32))
                total, before = total + 1, ""
            elif part:
                out.append(self._part_steps(part, units))
                total, before = total + int(out[-1].sum(dtype=np.int64)), part
        return out[0] if len(out) == 1 else np.concatenate([np.zeros(0, dtype=np.int8), *out])

    def all_steps(self, texts: list[str]) -> Iterator[np.ndarray]:
        """:meth:`prefix_steps` of each text; the units of some texts are learned together first."""
        some, size = [], 0
        for text in texts:
            if some and size + len(text) > LONG_TEXT:
                yield from self._learned(some)
                some, size = [], 0
            some.append(self._cut(text))
            size += len(text)
        yield from self._learned(some)

    def _learned(self, cuts: list[list[tuple[str, bool, list[str] | None]]]) -> Iterator[np.ndarray]:
        self.units.learn(set().union(*(units for cut in cuts for _, _, units in cut if units)))
        return map(self._cut_steps, cuts)

    def prefixes(self, text: str) -> np.ndarray:
        """Item k is the token count of the first k code points, encoded on their own."""
        return np.concatenate([[0], np.cumsum(self.prefix_steps(text), dtype=np.int64)])


_counters: dict[str, PrefixCounter] = {}


def counter(vocabulary: bytes) -> PrefixCounter:
    """The worker's counter for a vocabulary file's content, built once."""
    key = hashlib.md5(vocabulary).hexdigest()
    if key not in _counters:
        _counters[key] = PrefixCounter(vocabulary)
    return _counters[key]


def pack(steps: np.ndarray) -> bytes:
    """Prefix counts as steps from prefix to prefix, in the narrowest width that fits."""
    most = max(int(steps.max(initial=0)), -int(steps.min(initial=0)))
    width = 1 if most < 128 else 2 if most < 32768 else 4
    return bytes([width]) + steps.astype(f"<i{width}", copy=False).tobytes()


def _steps_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype=f"<i{packed[0]}", offset=1)


def unpack(packed: bytes) -> np.ndarray:
    """Prefix counts from :func:`pack`; item k is for the first k code points."""
    return np.concatenate([[0], np.cumsum(_steps_of(packed), dtype=np.int64)])


def token_total(packed: bytes) -> int:
    """Tokens of the whole text."""
    return int(_steps_of(packed).sum(dtype=np.int64))


def fitting_prefix(packed: bytes, budget: int) -> int:
    """Length in code points of the longest prefix with at most ``budget`` tokens."""
    if budget < 0:
        raise ValueError("no prefix has fewer than no tokens")
    steps, longest, base = _steps_of(packed), 0, 0
    # Some at a time: a text may be long.
    for at in range(0, len(steps), 1 << 20):
        counts = base + np.cumsum(steps[at : at + (1 << 20)], dtype=np.int64)
        fits = np.flatnonzero(counts <= budget)
        longest = at + int(fits[-1]) + 1 if len(fits) else longest
        base = int(counts[-1])
    return longest


def prefix_counts(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", store: bool = True, budget: int | None = None) -> DataFrame:
    """One row per input row: the key, ``n_bytes`` and ``n_tokens`` of the whole text, and
    with ``store`` the packed counts of every prefix as ``prefix_tokens``. With a
    ``budget`` also ``fitting_chars``, the code points of the longest prefix with at most
    so many tokens; it needs the stored counts.

    ``vocabulary`` is the path of a byte-level BPE file of the tokenizers library; the
    driver reads it (a few MB) and sends it to the workers. A null text counts as empty
    (0 tokens). Repeated rows stay repeated rows, other columns are left out, an empty
    table gives an empty one. Texts of any length are counted whole. A file with a normaliser,
    another split or other settings that are not known here is refused.
    """
    if budget is not None and (budget < 0 or not store):
        raise ValueError("a budget is a number of tokens, answered from the stored counts")
    python_tasks(df.sparkSession)
    with open(vocabulary, "rb") as f:
        content = f.read()
    _refuse_unknown(json.loads(content))
    shipped = df.sparkSession.sparkContext.broadcast(content)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = counter(shipped.value)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            made = {"key": batch["key"], "n_bytes": [len(t.encode()) for t in texts]}
            if store:
                packed = [pack(s) for s in counts.all_steps(texts)]
                made |= {"n_tokens": list(map(token_total, packed)), "prefix_tokens": packed}
                if budget is not None:
                    made["fitting_chars"] = [fitting_prefix(p, budget) for p in packed]
            else:
                made["n_tokens"] = counts.totals(texts)
            yield pd.DataFrame(made)

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, n_bytes long, n_tokens long" + ", prefix_tokens binary" * store + ", fitting_chars long" * (budget is not None)
    picked = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    return picked.mapInPandas(count, schema).withColumnRenamed("key", key)
