"""Byte-level BPE encoding and decoding, long texts by tree concatenation.

A short text is encoded at once. A long one is cut into leaves, which tasks encode apart, and put
together in rounds: two neighbours become one by encoding anew a window around their join, which
grows until it ends in tokens both sides have as well.

Two facts make the result exact. Where a letter or digit is followed by a sign that is neither,
the pattern that splits text before merging always splits, whatever surrounds the place; tokens on
both sides of such a place do not depend on each other. Within an unsplit run of letters, of digits
or of signs, a sequence of tokens is the encoding of its text if each two neighbours are the encoding
of theirs; so a window whose first and last tokens are the neighbours' own fits in. A special token is
cut out of a text before either, so no window ends inside one.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pampero.llm.common import buffers, slices, stage, text_bytes

#: Characters from which on a text is cut, and of a leaf; characters of the first window.
LONG = 1 << 16
LEAF = 1 << 14
WINDOW = 128

#: The pattern that splits text before merges, of the tokenizer family this operator is for.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


class Tokenizer:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, file: str):
        import tiktoken

        with open(file, encoding="utf-8") as stream:
            told = json.load(stream)
        byte_of = byte_alphabet()
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in token): number
            for token, number in told["model"]["vocab"].items()
            if token not in special
        }
        self.special = sorted(special)
        self.coder = tiktoken.Encoding(
            "byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.lengths = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for token, number in ranks.items():
            self.lengths[number] = len(token)
        for token, number in special.items():
            self.lengths[number] = len(token.encode())

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(self.coder.encode_to_numpy(text, allowed_special="all"), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return self.coder.decode_bytes(ids.tolist()).decode("utf-8", "replace")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the tokenizer file: itself where
    it is printable in Latin-1, else the next one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=1 << 16)
def in_word(c: str) -> bool:
    """Letters and digits of a Unicode version that every library knows."""
    return unicodedata.ucd_3_2_0.category(c)[0] in "LN"


@lru_cache(maxsize=1 << 16)
def kind_of(c: str) -> str:
    """``L`` for letters, ``N`` for digits, ``S`` for other visible signs, and nothing for the rest."""
    kind = unicodedata.ucd_3_2_0.category(c)[0]
    return kind if kind in "LN" else "S" if kind in "PS" else ""


def splits(text: str, at: int) -> bool:
    """Whether the text is split at a place, whatever lies beyond these two characters."""
    a, b = text[at - 1], text[at]
    return in_word(a) and b in " \n\t,.;:!?()\"-" and not in_word(b)


def inside(text: str, at: int, special: list[str]) -> bool:
    """Whether a place lies inside a special token."""
    return any(s in text[max(at - len(s) + 1, 0) : at + len(s) - 1] for s in special)


def split_from(text: str, at: int, end: int, special: list[str]) -> int | None:
    step = 1 if end > at else -1
    places = (p for p in range(at, end, step) if splits(text, p))
    return next((p for p in places if not inside(text, p, special)), None)


class Piece:
    """Tokens of a stretch of text, with the byte offset each ends at."""

    def __init__(self, text: str, ids: np.ndarray, tokenizer: Tokenizer):
        self.text, self.ids = text, ids
        self.ends = np.cumsum(tokenizer.lengths[ids])

    def index_at(self, offset: int) -> int | None:
        """How many tokens end by a byte offset, if one ends right there."""
        if offset == 0:
            return 0
        i = int(np.searchsorted(self.ends, offset))
        return i + 1 if i < len(self.ends) and self.ends[i] == offset else None


def join(left: Piece, right: Piece, tokenizer: Tokenizer) -> Piece:
    """The encoding of two neighbouring texts as one."""
    text = left.text + right.text
    middle, w = len(left.text), WINDOW
    while True:
        reach_left, reach_right = middle - w, middle + w
        whole = reach_left <= 1 and reach_right >= len(text) - 1
        if whole:
            return Piece(text, tokenizer.encode(text), tokenizer)
        found = _within_splits(left, right, text, middle, w, tokenizer)
        if found is None:
            found = _within_run(left, right, text, middle, w, tokenizer)
        if found is not None:
            return Piece(text, found, tokenizer)
        w *= 2


def _within_splits(left, right, text, middle, w, tokenizer):
    """Window between two places where the text is split in any case."""
    end, special = len(text), tokenizer.special
    p = q = None
    if middle > w:
        p = split_from(text, max(middle - w, 1), max(middle - 2 * w, 0), special)
    if middle + w < end:
        q = split_from(text, middle + w, min(middle + 2 * w, end), special)
    p = 0 if p is None and middle <= 2 * w else p
    q = len(text) if q is None and middle + 2 * w >= len(text) else q
    if p is None or q is None:
        return None
    head = left.index_at(len(text[:p].encode()))
    tail = 0 if q == middle else right.index_at(len(text[middle:q].encode()))
    if head is None or tail is None:
        return None
    return np.concatenate((left.ids[:head], tokenizer.encode(text[p:q]), right.ids[tail:]))


def _within_run(left, right, text, middle, w, tokenizer):
    """Window inside one run of letters, digits or signs, that agrees with its first and last tokens."""
    low, high = max(middle - w, 0), min(middle + w, len(text))
    kind = kind_of(text[middle])
    if not kind or not all(kind_of(c) == kind for c in text[low:high]):
        return None
    reach = max(map(len, tokenizer.special), default=0)
    around = text[max(low - reach, 0) : high + reach]
    if any(s in around for s in tokenizer.special):
        return None
    edge = len(text[: max(low, 0)].encode())
    head = int(np.searchsorted(left.ends, edge)) + 1 if low else 0
    tail_edge = len(text[middle:high].encode())
    tail = int(np.searchsorted(right.ends, tail_edge, side="right")) - 1
    tail = len(right.ids) if high == len(text) else tail
    if tail <= 0 or head >= len(left.ids):
        return None
    start = int(left.ends[head - 1]) if head else 0
    stop = int(right.ends[tail - 1])
    raw = left.text.encode()[start:] + right.text.encode()[:stop]
    try:
        ids = tokenizer.encode(raw.decode())
    except UnicodeDecodeError:  # a token ends inside a character: a wider window may not
        return None
    if head and (not len(ids) or ids[0] != left.ids[head]):
        return None
    if tail < len(right.ids) and ids[-1] != right.ids[tail - 1]:
        return None
    return np.concatenate((left.ids[:head], ids, right.ids[tail:]))


def tree(pieces: list[Piece], tokenizer: Tokenizer) -> Piece:
    """All pieces as one, neighbours joined in rounds."""
    while len(pieces) > 1:
        paired = [join(a, b, tokenizer) for a, b in zip(pieces[::2], pieces[1::2])]
        pieces = paired + pieces[len(paired) * 2 :]
    return pieces[0]


RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary, decoded string"


def results(ids: list[np.ndarray], tokenizer: Tokenizer, outputs: bool) -> list[pa.Array]:
    """Columns of ``RESULT``; the last two are null unless asked for."""
    decoded = [tokenizer.decode(i) for i in ids]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    packed = [i.astype("<u4").tobytes() for i in ids]
    return [
        pa.array([len(i) for i in ids], pa.int64()),
        pa.array([sha(p) for p in packed], pa.string()),
        pa.array([sha(d.encode("utf-8", "surrogatepass")) for d in decoded], pa.string()),
        pa.array(packed if outputs else [None] * len(ids), pa.binary()),
        pa.array(decoded if outputs else [None] * len(ids), pa.string()),
    ]


def encode_texts(
    docs: DataFrame,
    file: str,
    outputs: bool = True,
    long: int = LONG,
    leaf: int = LEAF,
) -> DataFrame:
    """One row per input row: ``doc_id`` and the columns of ``RESULT``.

    ``file`` is a tokenizer file every task can open. ``ids`` are little-endian unsigned 32-bit
    integers. Null and empty texts have no tokens. The strings of special tokens in a text are
    these tokens. Texts of ``long`` characters or more are cut into leaves of ``leaf``
    characters, which are dealt to all tasks. Rows repeating an id are encoded each. An empty
    table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    is_long = F.length(F.coalesce("text", F.lit(""))) >= long

    def at_once(batches):
        tokenizer = Tokenizer(file)
        for batch in slices(batches, "body"):
            ids = [tokenizer.encode(b.decode("utf-8", "replace")) for b in buffers(batch, "body")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *results(ids, tokenizer, outputs)], names=names
            )

    def encode_leaves(batches):
        tokenizer = Tokenizer(file)
        for batch in slices(batches, "body"):
            ids = [tokenizer.encode(b.decode("utf-8", "replace")) for b in buffers(batch, "body")]
            packed = pa.array([i.tobytes() for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, packed], names=["row", "doc_id", "place", "body", "ids"]
            )

    def put_together(batches):
        tokenizer = Tokenizer(file)
        held, key, doc = [], None, None

        def emit():
            ids = tree(held, tokenizer).ids
            return pa.RecordBatch.from_arrays(
                [pa.array([doc], doc_type), *results([ids], tokenizer, outputs)], names=names
            )

        for batch in batches:
            doc_type = batch.column(1).type
            for row, doc_id, _, body, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if row != key and held:
                    yield emit()
                    held = []
                key, doc = row, doc_id
                held.append(Piece(body.decode(), np.frombuffer(ids, np.uint32), tokenizer))
        if held:
            yield emit()

    short = docs.where(~is_long).select("doc_id", text_bytes().alias("body"))
    # Stored, so that a row number means the same text in every later read.
    texts = stage(
        docs.where(is_long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
        "long-texts",
    )
    starts = F.sequence(F.lit(1), F.length("text"), F.lit(leaf))
    cut = F.substring("text", F.col("place"), F.lit(leaf))
    leaves = texts.select("row", "doc_id", "text", F.explode(starts).alias("place")).select(
        "row", "doc_id", "place", F.encode(cut, "UTF-8").alias("body")
    )
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = leaves.repartition(parts, "row", "place").mapInArrow(
        encode_leaves, f"row long, doc_id {kind}, place int, body binary, ids binary"
    )
    joined = (
        encoded.repartition(parts, "row")
        .sortWithinPartitions("row", "place")
        .mapInArrow(put_together, f"doc_id {kind}, {RESULT}")
    )
    return short.mapInArrow(at_once, f"doc_id {kind}, {RESULT}").union(joined)
