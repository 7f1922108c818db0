"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece of a model has a whitespace marker after another character, the
merges inside one marked word can't depend on its neighbours. The same holds at
newlines if no piece contains one. So every distinct chunk is segmented once for
the whole corpus:

1. Each block of documents (some MB of text) becomes a list of its distinct
   chunks and, per document, their positions. Lists are dealt into slots by a
   hash of the chunk, so a chunk that occurs everywhere travels once per block.
2. A slot's task meets all blocks' chunks with that hash and segments every
   distinct one a single time.
3. Ids return to their blocks, which join them by position. The blocks' positions
   are shuffled once, by block; both steps read that same exchange.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orderloom.llm.tables import whole_text

MARK = "▁"
BLOCK_BYTES = 16 << 20
JOIN_CODES = 1 << 20  # chunks joined at a time
ODD = f"^$|  |^ | $| \n|{MARK}"  # texts whose chunks aren't simply what stands between single spaces
CHUNKS = re.compile(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*")


def load_model(path: str):
    """The model, if its chunks are independent; ValueError otherwise."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if MARK in piece.lstrip(MARK) or "\n" in piece:
            raise ValueError(f"piece {piece!r} crosses a chunk's border")
    if model.encode("  á ﬁ ", out_type=str)[:1] != model.encode(" ", out_type=str)[:1] or model.decode(model.encode(" ﬁ  a ")) != " ﬁ  a ":
        raise ValueError("the model changes its text before it segments it")
    return model


def split_chunks(text: str) -> list[str]:
    """Chunks of one text. Without its first marker each; one that starts with a newline has none."""
    if not text:
        return []
    marked = MARK + text.replace(" ", MARK)
    return [c if c[0] == "\n" else c[1:].replace(MARK, " ") for c in CHUNKS.findall(marked)]


def _segment(model, chunks: list[str]) -> list[list[int]]:
    mark = model.piece_to_id(MARK)
    return [(ids[1:] if c[:1] == "\n" else ids) if c else [mark] for c, ids in zip(chunks, model.encode(chunks, num_threads=1))]


def _pack(array: np.ndarray) -> bytes:
    """Little-endian bytes in planes, which compress better than whole numbers."""
    flat = np.ascontiguousarray(array)
    planes = flat.view(np.uint8).reshape(-1, flat.itemsize).T if len(flat) else np.zeros(0, np.uint8)
    return _squeeze(np.ascontiguousarray(planes).tobytes())


def _unpack(body: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(_unsqueeze(body), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def _squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def _unsqueeze(body: bytes) -> bytes:
    size = int.from_bytes(body[:8], "little")
    return pa.decompress(body[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts in runs of about ``limit`` bytes; a longer text is a run of its own."""
    held, size = [], 0
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            upto = max(int(np.searchsorted(ends, before + limit - size, "right")), at + (not held))
            if upto > at:
                held.append((ids.slice(at, upto - at), texts.slice(at, upto - at)))
                size += int(ends[upto - 1] - before)
            at = upto
            if at < len(texts):
                yield tuple(pa.concat_arrays(x) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(pa.concat_arrays(x) for x in zip(*held))


def _block_chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Chunks per text, their codes in order, and the distinct chunks by code."""
    odd = np.flatnonzero(pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False))
    plain = texts
    if len(odd):
        mask = np.zeros(len(texts), bool)
        mask[odd] = True
        plain = pc.if_else(pa.array(mask), pa.scalar("", texts.type), texts)
    lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
    coded = lists.flatten().dictionary_encode()
    codes, counts = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.diff(lists.offsets.to_numpy())
    distinct = coded.dictionary
    if len(odd):
        known = {c: i for i, c in enumerate(distinct.to_pylist())}
        parts, at = [], np.concatenate([[0], np.cumsum(counts)])
        done = 0
        for row in odd:
            own = [known.setdefault(c, len(known)) for c in split_chunks(texts[int(row)].as_py())]
            parts += [codes[at[done] : at[row]], np.array(own, np.int64)]
            counts[row], done = len(own), row + 1
        codes = np.concatenate([*parts, codes[at[done] :]])
        distinct = pa.array(list(known), texts.type)
    return counts, codes, distinct


def _dealer(slots: int, limit: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, (ids, texts) in enumerate(_blocks(batches, limit)):
            counts, codes, distinct = _block_chunks(texts)
            words = distinct.to_pylist()
            slot = np.fromiter((zlib.crc32(w.encode()) % slots for w in words), np.int32, len(words))
            block = (task << 32) + k
            order = np.argsort(slot, kind="stable")
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(slot[order])) + 1, [len(order)]]) if len(order) else []
            rows = [(block, -1, _pack(codes.astype("<u4")), _pack(counts.astype("<u4")), _pack(slot), ids)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                own = order[a:b]
                chunks = [words[i].encode() for i in own]
                sizes = np.fromiter(map(len, chunks), "<u4", len(chunks))
                rows.append((block, int(slot[own[0]]), _squeeze(b"".join(chunks)), _pack(sizes), None, None))
            columns = list(zip(*rows))
            keep = pa.concat_arrays([pa.ListArray.from_arrays([0, len(ids)], ids), pa.nulls(len(rows) - 1, pa.list_(ids.type))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[2:5]), keep],
                names=["block", "slot", "body", "counts", "dealt", "ids"],
            )

    return deal


def _listed(body: bytes, sizes: bytes) -> list[str]:
    raw, ends = _unsqueeze(body), np.cumsum(_unpack(sizes, "<u4").astype(np.int64)).tolist()
    return [raw[a:b].decode() for a, b in zip([0, *ends], ends)]


def _segmenter(path: str):
    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, at, known = load_model(path), None, {}
        for batch in batches:
            for block, slot, body, lengths in zip(*(batch.column(c).to_pylist() for c in ("block", "slot", "body", "counts"))):
                if slot != at:
                    at, known = slot, {}
                words = _listed(body, lengths)
                new = [w for w in words if w not in known]
                known.update((w, np.array(ids, "<u4").tobytes()) for w, ids in zip(new, _segment(model, new) if new else ()))
                found = [known[w] for w in words]
                sizes = np.fromiter(map(len, found), "<u4", len(found)) // 4
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        pa.array([slot], pa.int32()),
                        pa.array([_pack(np.frombuffer(b"".join(found), "<u4"))], pa.binary()),
                        pa.array([_pack(sizes.astype("<u4"))], pa.binary()),
                    ],
                    names=["block", "slot", "body", "counts"],
                )

    return segment


def _lists_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A filter in the plan would be pushed below the exchange, and the two readers couldn't share it.
    for batch in batches:
        yield batch.filter(pc.greater_equal(batch.column("slot"), 0)).select(["block", "slot", "body", "counts"])


def _joiner(path: str, out: pa.Schema):
    def join(block: pa.Table, segmented: pa.Table) -> pa.Table:
        model = load_model(path)
        own = block.filter(pc.equal(block["slot"], -1))
        doc_ids = own["ids"].combine_chunks().flatten()
        head = own.select(["body", "counts", "dealt"]).to_pylist()[0]
        codes, counts = _unpack(head["body"], "<u4"), _unpack(head["counts"], "<u4").astype(np.int64)
        order = np.argsort(_unpack(head["dealt"], "<i4"), kind="stable")
        parts = sorted(segmented.select(["slot", "body", "counts"]).to_pylist(), key=lambda r: r["slot"])
        sizes = np.concatenate([np.zeros(0, np.int64), *(_unpack(r["counts"], "<u4").astype(np.int64) for r in parts)])
        ids = np.concatenate([np.zeros(0, "<u4"), *(_unpack(r["body"], "<u4") for r in parts), np.array([model.bos_id(), model.eos_id()], "<u4")])
        # Back from slot order to the block's codes; two more codes stand for begin and end.
        n, place = len(order), np.empty(len(order), np.int64)
        place[order] = np.arange(n)
        id_size, id_start = np.append(sizes[place], [1, 1]), np.append((np.cumsum(sizes) - sizes)[place], [len(ids) - 2, len(ids) - 1])
        ends, made, at = np.cumsum(counts), [], 0
        while at < len(counts):
            before = int(ends[at - 1]) if at else 0
            upto = max(int(np.searchsorted(ends, before + JOIN_CODES, "right")), at + 1)
            own_ends = ends[at:upto] - before
            frame = np.stack([np.append(0, own_ends[:-1]), own_ends], 1).reshape(-1)
            framed = np.insert(codes[before : int(ends[upto - 1])].astype(np.int64), frame, np.tile([n, n + 1], upto - at))
            own_size = id_size[framed]
            id_ends = np.cumsum(own_size)
            flat = ids[np.repeat(id_start[framed] - (id_ends - own_size), own_size) + np.arange(int(id_ends[-1]))]
            cut = np.append(0, id_ends[np.cumsum(counts[at:upto] + 2) - 1])
            blob = flat.astype("<u4").tobytes()
            made.append(
                pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(at, upto - at),
                        pa.array(np.diff(cut), pa.int64()),
                        pa.array([blob[4 * a : 4 * b] for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
                        pa.array([model.decode(flat[a:b].tolist()) for a, b in zip(cut[:-1], cut[1:])], pa.string()),
                    ],
                    schema=out,
                )
            )
            at = upto
        return pa.Table.from_batches(made, out)

    return join


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids (little-endian uint32), decoded text.

    Ids have begin and end ids and equal the library's for the whole text;
    ``decoded`` is its ``decode(ids)``. Null and empty texts give the two ids
    and an empty text. Any length is taken whole, repeated rows give repeated
    results, a null id stays null, other columns are ignored, and an empty table
    gives no rows.
    """
    load_model(model_path)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema[id_col].dataType
    binary = T.BinaryType()
    lists = T.StructType([T.StructField(n, t) for n, t in (("block", T.LongType()), ("slot", T.IntegerType()), ("body", binary), ("counts", binary))])
    dealt_type = T.StructType([*lists.fields, T.StructField("dealt", binary), T.StructField("ids", T.ArrayType(id_type))])
    texts = docs.select(F.col(id_col).alias("__id"), whole_text(text_col).alias("__text"))
    dealt = texts.mapInArrow(_dealer(2 * partitions, block_bytes), dealt_type).repartition(partitions, "block")
    by_slot = dealt.mapInArrow(_lists_only, lists).repartition("slot").sortWithinPartitions("slot")
    segmented = by_slot.mapInArrow(_segmenter(model_path), lists)
    result = T.StructType([T.StructField(id_col, id_type), T.StructField("n_tokens", T.LongType()), T.StructField("ids", binary), T.StructField("decoded", T.StringType())])
    join = _joiner(model_path, to_arrow_schema(result))
    return dealt.groupBy("block").cogroup(segmented.groupBy("block")).applyInArrow(join, result)
