"""Packing of documents into training sequences by the sum-of-squares rule, online.

A document's ids end in the end id. What fills whole windows is cut off first; the rest
goes, as one piece, into the open window whose fill level makes the sum over all levels of
the squared number of windows open at that level smallest. A level array holds these
numbers, so a placement looks at levels, not at windows.

Every partition of the input is packed by itself, in one pass and without a shuffle; a
window never spans two partitions, and a task that is run again packs the same rows the
same way. When ``MOST_OPEN`` windows are open, and at the end, they are closed by cutting:
the emptiest ones are handed out to the fullest. What is left then, less than a window, is
cut into windows of sizes that are powers of two, which need no padding.
"""

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import python_tasks
from tierline.llm.token_counts import SPLIT, _byte_letters as byte_letters

WINDOW = 1024
END_ID = 0

#: Windows a packer keeps open before it closes them by cutting: its memory.
MOST_OPEN = 4096

#: Sequence numbers of one partition.
NUMBER_BITS = 40

#: Levels that hold no window, as a score nothing falls below.
_NONE = 1 << 40

#: A piece: number of its document, start in it, ids.
Piece = tuple[int, int, np.ndarray]


class Packer:
    """Windows being filled. ``put`` takes a document's rest, ``close`` ends the packing;
    both give the windows that became full or were closed, as lists of pieces.

    Cutting may share a window's pieces out to several others; no id is lost or repeated.
    """

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN):
        self.window = window
        self.most_open = most_open
        #: Open windows by level, and how many there are.
        self.open: list[list[list[Piece]]] = [[] for _ in range(window)]
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.given = np.full(window + 1, _NONE, dtype=np.int64)
        self.held = 0

    def level(self, size: int) -> int:
        """The fill level, 0 for a new window, that the sum of squares chooses for a piece
        of ``size`` ids; of equal ones the fullest.

        The sum grows by 2 N(level + size) - 2 N(level) + 2 where a window of a level in use
        takes the piece, by 2 N(size) + 1 for a new window, and by 1 - 2 N(level) where a
        window gets full, since full ones are not counted.
        """
        count, given = self.count, self.given
        full = self.window - size
        best, score = 0, 2 * int(count[size]) + 1
        if count[full] > 0 and 1 - 2 * int(count[full]) <= score:
            best, score = full, 1 - 2 * int(count[full])
        grown = count[size + 1 : self.window] + given[1:full]
        if len(grown):
            # From the fullest level down, so that the first of equal ones is the fullest.
            at = len(grown) - 1 - int(grown[::-1].argmin())
            found = 2 * int(grown[at]) + 2
            if found < score or (found == score and at + 1 > best):
                best = at + 1
        return best

    def _counted(self, level: int, by: int) -> None:
        self.count[level] += by
        self.given[level] = -self.count[level] if self.count[level] else _NONE
        self.held += by

    def _keep(self, window: list[Piece], level: int) -> None:
        self.open[level].append(window)
        self._counted(level, 1)

    def put(self, piece: Piece) -> list[list[Piece]]:
        """Place a piece of 1 to ``window`` - 1 ids."""
        size = len(piece[2])
        level = self.level(size)
        window = [piece]
        if level:
            window = self.open[level].pop()
            self._counted(level, -1)
            window.append(piece)
        if level + size == self.window:
            return [window]
        self._keep(window, level + size)
        return self._cut_up() if self.held >= self.most_open else []

    def _cut_up(self) -> list[list[Piece]]:
        """Close the open windows: the emptiest ones' pieces fill up the fullest. The last
        one stays open."""
        windows = [(level, w) for level in range(self.window - 1, 0, -1) for w in self.open[level]]
        self.open = [[] for _ in range(self.window)]
        self.count[:] = 0
        self.given[:] = _NONE
        self.held = 0
        full, donor = [], len(windows) - 1
        loose: list[Piece] = []
        for at, (level, window) in enumerate(windows):
            if at > donor:
                break
            while level < self.window:
                if not loose:
                    if donor <= at:
                        break
                    loose, donor = windows[donor][1], donor - 1
                document, start, ids = loose.pop()
                room = self.window - level
                window.append((document, start, ids[:room]))
                if len(ids) > room:
                    loose.append((document, start + room, ids[room:]))
                level += len(window[-1][2])
            if level == self.window:
                full.append(window)
            else:
                self._keep(window, level)
        if loose:
            self._keep(loose, sum(len(ids) for _, _, ids in loose))
        return full

    def close(self) -> list[list[Piece]]:
        """Close all windows; the last ones' fills are powers of two."""
        out = self._cut_up()
        rest = [piece for level in self.open for window in level for piece in window]
        left = sum(len(ids) for _, _, ids in rest)
        rest.reverse()
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            window = []
            while size:
                document, start, ids = rest.pop()
                window.append((document, start, ids[:size]))
                if len(ids) > size:
                    rest.append((document, start + size, ids[size:]))
                size -= len(window[-1][2])
            out.append(window)
        return out


def _merged_last(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, ...]:
    """What is left of a token's bytes when all merges below its own rank are done."""
    parts, limit = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= limit:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return tuple(parts)


def ranks_suffice(vocabulary: bytes) -> bool:
    """Whether the ranks of the tokens alone give the library's ids: a byte-level file of
    the one split, ids in the order of merges, added tokens that are plain strings, and
    each token's own bytes ending up as the pair that its merge names."""
    spec = json.loads(vocabulary)
    model, plain = spec["model"], ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
    split = spec.get("pre_tokenizer") or {}
    if model.get("type", "BPE") != "BPE" or any(model.get(name) for name in (*plain, "ignore_merges")) or spec.get("normalizer"):
        return False
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or split.get("use_regex") is False:
        return False
    if any(t.get(name) for t in spec.get("added_tokens", []) for name in ("single_word", "lstrip", "rstrip", "normalized")):
        return False
    ranks, merges = _ranks(spec), [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if ranks is None or any(bytes([b]) not in ranks for b in range(256)):
        return False
    letter = byte_letters()
    pairs = [tuple(bytes(letter[c] for c in part) for part in m) for m in merges]
    made = [ranks.get(a + b, -1) for a, b in pairs]
    if min(made, default=0) < 0 or made != sorted(set(made)) or len(made) + 256 != len(ranks):
        return False
    return all(_merged_last(a + b, ranks) == (a, b) for a, b in pairs)


def _ranks(spec: dict) -> dict[bytes, int] | None:
    """The ids of the tokens as bytes, added ones left out; None if some are not bytes."""
    letter = byte_letters()
    added = {t["content"] for t in spec.get("added_tokens", [])}
    tokens = [(text, i) for text, i in spec["model"]["vocab"].items() if text not in added]
    if not all(c in letter for text, _ in tokens for c in text):
        return None
    return {bytes(letter[c] for c in text): i for text, i in tokens}


def encoder(vocabulary: bytes, by_ranks: bool) -> Callable[[str], np.ndarray]:
    """Ids of a text as the tokenizers library gives them for a vocabulary file's content,
    without begin, end or other added tokens; strings of special tokens in the text are
    those tokens.

    Where :func:`ranks_suffice`, tiktoken finds the same ids several times faster.
    """
    spec = json.loads(vocabulary)
    if not by_ranks:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(vocabulary.decode())
        library.no_truncation()
        library.no_padding()
        return lambda text: np.array(library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    import tiktoken

    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranked = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=_ranks(spec), special_tokens=added)
    return lambda text: ranked.encode_to_numpy(text, allowed_special="all")


def pack(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, most_open: int = MOST_OPEN) -> DataFrame:
    """One row per piece: ``key``, ``start`` (its document's ids before it), ``length``,
    ``ids`` (little-endian unsigned 32-bit), ``doc_tokens`` (its document's ids with the end
    id), ``sequence_id``, and ``offset`` in that sequence, which has no gaps.

    A sequence has ``window`` ids, or a power of two: what a partition leaves over. A null
    or empty text is a document of the end id alone; a null key is a key; repeated rows are
    documents of their own, told apart by nothing but their pieces' places. Texts of any
    length are packed whole. Other columns are left out; an empty table has no pieces.
    """
    if window < 2:
        raise ValueError("a window has two ids or more")
    python_tasks(df.sparkSession)
    with open(vocabulary, "rb") as f:
        content = f.read()
    shipped = df.sparkSession.sparkContext.broadcast((content, ranks_suffice(content)))
    kind = df.schema[key].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*shipped.value)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << NUMBER_BITS
        packer = Packer(window, most_open)
        # Keys and sizes of documents that have pieces in open windows.
        known: dict[int, tuple] = {}
        pending: dict[int, int] = {}
        seen = 0

        def rows(windows: list[list[Piece]]) -> Iterator[tuple]:
            nonlocal number
            for pieces in windows:
                offset = 0
                for document, start, ids in pieces:
                    name, size = known[document]
                    yield name, start, len(ids), ids.tobytes(), size, number, offset
                    offset += len(ids)
                    pending[document] -= len(ids)
                    if not pending[document]:
                        del known[document], pending[document]
                number += 1

        def batch_of(made: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
            types = [key_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*made, strict=True) if made else ([] for _ in types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        key_type = None
        for batch in batches:
            made = []
            key_type = batch.schema.field("key").type
            for name, content in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(encode(content or "").astype("<u4", copy=False), np.uint32(end_id)).astype("<u4", copy=False)
                known[seen] = name, len(ids)
                pending[seen] = len(ids)
                whole = len(ids) - len(ids) % window
                full = [[(seen, at, ids[at : at + window])] for at in range(0, whole, window)]
                if whole < len(ids):
                    # A copy, so that an open window does not hold the whole document.
                    full += packer.put((seen, whole, ids[whole:].copy()))
                made += rows(full)
                seen += 1
            yield batch_of(made, key_type)
        if key_type is not None:
            yield batch_of(list(rows(packer.close())), key_type)

    schema = f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    picked = df.select(df[key].alias("key"), df[text].cast("string").alias("text"))
    return picked.mapInArrow(packed, schema).withColumnRenamed("key", key)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``n_ids``, and ``ids`` as one binary value,
    from the pieces of :func:`pack`. A sequence has a window's pieces at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform(parts, lambda p: F.hex(p["ids"])), F.lit(""), lambda a, b: F.concat(a, b))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), F.unhex(joined).alias("ids"))
