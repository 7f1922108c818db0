"""Packing and SentencePiece against the libraries; the pipeline's stages."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import SF, TEXTS, documents, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import packing, sentencepieces
from orderloom.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TOKENS = Tokenizer.from_file(BYTES)


def check_packing(rows, docs, length=1024):
    want = sorted((i or 0, len(TOKENS.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in docs)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id or 0, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == sorted(set(want))
    for (i, n), pieces in by_doc.items():
        copies = want.count((i, n))
        assert sum(p.length for p in pieces) == n * copies
        texts = {t or "" for d, t in docs if (d or 0) == i}
        for p in pieces:
            sums = {zlib.crc32(np.array(TOKENS.encode(t, add_special_tokens=False).ids + [0], "<u4")[p.start : p.start + p.length].tobytes()) for t in texts}
            assert p.ids_crc32 in sums
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert padding == 0


def test_packing_query(spark):
    check_packing(QUERIES["op8_packing"](spark, SF).collect(), documents())


def test_packing_edges(spark):
    check_packing(packing.pack_documents(edge_docs(spark), BYTES, group_rows=3).collect(), TEXTS)
    assert packing.pack_documents(empty_docs(spark), BYTES).count() == 0


def test_first_fit_decreasing_is_first_fit():
    rnd = random.Random(1)
    for _ in range(50):
        sizes = np.array([rnd.randint(1, 100) for _ in range(rnd.randint(0, 60))])
        room, bins = [], []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            k = next((k for k, r in enumerate(room) if r >= sizes[i]), None)
            if k is None:
                room.append(100)
                bins.append([])
                k = len(bins) - 1
            room[k] -= sizes[i]
            bins[k].append(i)
        assert packing.first_fit_decreasing(sizes, 100) == bins


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_byte_tokens_are_the_librarys(text):
    assert TOKENISER.encode(text).tolist() == TOKENS.encode(text, add_special_tokens=False).ids


TOKENISER = packing.ByteTokenizer(BYTES)
LOADED = sentencepieces.load_model(MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é▁ \n\t𝒳ﬁ.0")), max_size=30) | st.text(max_size=40))
def test_chunks_are_independent(text):
    chunks = sentencepieces.split_chunks(text)
    assert [i for ids in (sentencepieces._segment(LOADED, chunks) if chunks else []) for i in ids] == PIECES.encode(text)


def expected_pieces(docs):
    out = []
    for i, t in docs:
        ids = PIECES.encode(t or "", add_bos=True, add_eos=True)
        out.append((i or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(PIECES.decode(ids).encode()).hexdigest()))
    return sorted(out)


def test_pieces_query(spark):
    assert sorted(map(tuple, QUERIES["op10_sentencepiece"](spark, SF).collect())) == expected_pieces(documents())


@pytest.mark.parametrize("block_bytes", [200, 1 << 20])
def test_pieces_edges(spark, block_bytes):
    rows = sentencepieces.encode_documents(edge_docs(spark), MODEL, block_bytes=block_bytes).collect()
    got = [(r.doc_id or 0, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), hashlib.sha256(r.decoded.encode()).hexdigest()) for r in rows]
    assert sorted(got) == expected_pieces(TEXTS)
    assert sentencepieces.encode_documents(empty_docs(spark), MODEL).count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = {r.doc_id: r for r in docs.collect()}, docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        step(spark, docs, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        rows = {r.doc_id: r for r in after.collect()}
        assert after.columns == columns and rows.keys() <= before.keys() and len(rows) > 0.8 * len(before)
        if name in ("quality_classifier", "ngram_jaccard_join"):
            assert all(rows[i] == before[i] for i in rows)
        if name == "secret_scan":
            assert rows.keys() == before.keys()
        assert all(r.n_chars == len(r.text) for r in rows.values())
        docs, before = after, rows
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), [(i, r.text) for i, r in before.items()])


CLASHES = ["__x", "quality_score", "quality_predicted", "__id", "__hash", "__text_hash", "__removed", "__lines", "__rid", "__spans", "__candidates", "first", "stays", "rows"]


def test_pipeline_bears_edge_rows(spark):
    """Which rows each stage keeps, that their other columns stay as they are, and that no name is in the way."""
    docs = edge_docs(spark).withColumns({c: F.concat(F.lit(c), F.coalesce("doc_id", F.lit(-1))) for c in CLASHES})
    rows = [r.asDict() for r in docs.collect()]

    def stays(r, text):
        return {**r, "text": text}

    cut = dict(enumerate(rows))
    cut[4] = stays(cut[4], "short")  # both long lines are in document 4
    for i in (5, 6):
        cut[i] = stays(cut[i], "short\nsomething else of no length at all, really not")
    want = {
        "line_dedup": list(cut.values()),
        # a copy, a row that is repeated, and a near copy go
        "ngram_jaccard_join": [r for i, r in enumerate(rows) if i not in (4, 6, 10)],
        "secret_scan": [stays(r, r["text"] and r["text"].replace("token=abcdefgh12", "[SECRET]")) for r in rows],
    }
    for name, step in corpus_pipeline.STAGES[:-1]:
        got = [r.asDict() for r in step(spark, docs, SF).collect()]
        if name in want:
            assert sorted(map(repr, got)) == sorted(map(repr, want[name])), name
        else:
            assert {repr(r) for r in got} <= {repr(r) for r in rows}
        assert step(spark, docs.limit(0), SF).count() == 0 and step(spark, docs.limit(0), SF).columns == docs.columns
    check_packing(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), [(r["doc_id"], r["text"]) for r in rows])
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_pipeline_keeps_one_row_of_each_group_with_null_and_repeated_ids(spark):
    def text(name, changed=""):
        return " ".join(f"{name}{i}" for i in range(80)) + changed

    rows = [(1, text("a")), (2, text("a", " end")), (2, text("b")), (None, text("a", " last")), (None, text("c")), (None, text("c", " end")), (5, text("d")), (5, text("d")), (6, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()), key=repr)
    fixed = [rows[0], rows[2], rows[6], rows[8], rows[9]]
    assert sorted([*fixed, rows[4]], key=repr) == got or sorted([*fixed, rows[5]], key=repr) == got
