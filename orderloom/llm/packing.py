"""Packing token ids into sequences: first-fit decreasing with a tournament tree.

Documents are tokenised in a narrow stage. Whole sequences are cut from a
document on the spot, so only the rest of it (less than one sequence) travels.
Rests are dealt at random into groups of bounded size, and every group packs its
own by first-fit decreasing: a tournament tree over the bins' free room finds
the first bin that fits in a logarithmic number of steps. Then the emptiest bins
are cut up to fill the gaps of the others, and the one bin left over is cut
into powers of two, which need no padding.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.tables import whole_text

SEQUENCE = 1024
GROUP_ROWS = 2048
END_ID = 0

# Fixed value: the pattern that byte-level vocabularies of this family split text by.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class ByteTokenizer:
    """Ids as the ``tokenizers`` library gives them for a byte-level BPE file.

    If the file's merges stand in the order of their ids, the ids are found by
    ``tiktoken``, which applies the same merges several times faster; otherwise
    by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        spec = json.loads(open(path, encoding="utf-8").read())
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        chars = _byte_of_char()
        made = [vocab.get(a + b) for a, b in pairs]
        pre = spec.get("pre_tokenizer") or {}
        standard = (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space")
            and None not in made
            and made == sorted(set(made))
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", []))
        )
        self._special = tuple(special)
        if standard:
            import tiktoken

            ranks = {bytes(chars[c] for c in token): i for token, i in vocab.items() if token not in special}
            self._fast = tiktoken.Encoding("packing", pat_str=WORDS, mergeable_ranks=ranks, special_tokens=special)
        else:
            from tokenizers import Tokenizer

            self._fast, self._slow = None, Tokenizer.from_file(path)

    def encode(self, text: str) -> np.ndarray:
        if self._fast is None:
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)
        allowed = "all" if any(s in text for s in self._special) else set()
        return self._fast.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())


def _checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokeniser(path: str, length: int, end_id: int, out: pa.Schema):
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ByteTokenizer(path)
        for batch in batches:
            totals, sums, rests = [], [], []
            for text in batch.column(2):
                ids = np.append(tokenizer.encode(text.as_py()), np.uint32(end_id))
                cut = len(ids) // length * length
                totals.append(len(ids))
                sums.append([_checksum(ids[i : i + length]) for i in range(0, cut, length)])
                rest = ids[cut:]
                small = rest.astype("<u2") if not len(rest) or rest.max() < 1 << 16 else rest.astype("<u4")
                rests.append((2 if small.itemsize == 2 else 4).to_bytes(1, "little") + small.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.int64()), pa.array(sums, pa.list_(pa.int64())), pa.array(rests, pa.binary())],
                schema=out,
            )

    return tokenise


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Items per bin. The tree's leaves are the bins' free room, inner nodes the winner of their two."""
    order = np.argsort(-sizes, kind="stable")
    leaves = 1
    while leaves < max(len(sizes), 1):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins: list[list[int]] = []
    for item in order.tolist():
        size, node = int(sizes[item]), 1
        while node < leaves:  # the leftmost bin with room
            node *= 2
            node += tree[node] < size
        if node - leaves == len(bins):
            bins.append([])
        bins[node - leaves].append(item)
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins


def fill_gaps(bins: list[list[int]], sizes: np.ndarray, capacity: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, start, length) without padding: gaps are filled from the emptiest bins."""
    pieces = [[(i, 0, int(sizes[i])) for i in b] for b in bins]
    pieces.sort(key=lambda b: -sum(p[2] for p in b))
    front, back = 0, len(pieces) - 1
    while front < back:
        gap = capacity - sum(p[2] for p in pieces[front])
        while gap and pieces[back]:
            item, start, size = pieces[back].pop()
            if size > gap:
                pieces[back].append((item, start + gap, size - gap))
                size = gap
            pieces[front].append((item, start, size))
            gap -= size
        if not pieces[back]:
            back -= 1
        if not gap:
            front += 1
    full, left = [p for p in pieces[: back + 1] if sum(x[2] for x in p) == capacity], [p for p in pieces[: back + 1] if 0 < sum(x[2] for x in p) < capacity]
    for rest in left:  # at most one
        rest = rest[::-1]
        room = sum(p[2] for p in rest)
        while room:
            want = 1 << (room.bit_length() - 1)
            room -= want
            made = []
            while want:
                item, start, size = rest.pop()
                if size > want:
                    rest.append((item, start + want, size - want))
                    size = want
                made.append((item, start, size))
                want -= size
            full.append(made)
    return full


def _packer(length: int, id_col: str):
    columns = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        base = int(rows["__group"].iloc[0]) << 32
        # The same order after a task is repeated, whatever order its rows come in.
        rows = rows.sort_values("__row", kind="stable")
        doc, total = rows["__id"].tolist(), rows["__total"].to_numpy()
        rests = [np.frombuffer(b, "<u2" if b[0] == 2 else "<u4", offset=1) for b in rows["__rest"]]
        out, sequence = [], base
        for i, sums in enumerate(rows["__sums"]):
            for k, crc in enumerate(sums):
                out.append((doc[i], k * length, length, int(crc), int(total[i]), sequence, 0))
                sequence += 1
        sizes = np.array([len(r) for r in rests], np.int64)
        some = np.flatnonzero(sizes)
        for packed in fill_gaps(first_fit_decreasing(sizes[some], length), sizes[some], length):
            offset = 0
            for item, start, size in packed:
                i = int(some[item])
                out.append((doc[i], int(total[i] - sizes[i]) + start, size, _checksum(rests[i][start : start + size]), int(total[i]), sequence, offset))
                offset += size
            sequence += 1
        return pd.DataFrame(out, columns=columns)

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = SEQUENCE,
    group_rows: int = GROUP_ROWS,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and ``end_id``; ``ids_crc32`` is over the piece's ids as
    little-endian uint32. Each id lies in exactly one piece. Null and empty texts
    are documents of one id. Any length is taken whole. Rows with the same id are
    packed as documents of their own; a null id stays null. An empty table gives
    no rows; other columns are ignored.
    """
    rows = docs.count()
    groups = max(1, -(-rows // group_rows))
    id_type = docs.schema[id_col].dataType
    row_no = F.monotonically_increasing_id()
    numbered = docs.select(F.col(id_col).alias("__id"), row_no.alias("__row"), whole_text(text_col).alias("__text"))
    fields = [("__id", id_type), ("__row", T.LongType()), ("__total", T.LongType()), ("__sums", T.ArrayType(T.LongType())), ("__rest", T.BinaryType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    tokens = numbered.mapInArrow(_tokeniser(tokenizer_path, length, end_id, to_arrow_schema(schema)), schema)
    # By the row's number, not its id: rows that share an id don't share a group.
    dealt = tokens.withColumn("__group", F.pmod(F.xxhash64("__row"), F.lit(groups)))
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    result = T.StructType([T.StructField(id_col, id_type), *(T.StructField(n, T.LongType()) for n in names)])
    return dealt.groupBy("__group").applyInPandas(_packer(length, id_col), result)
