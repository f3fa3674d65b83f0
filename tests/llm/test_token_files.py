import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, clashing, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from edgeloom.llm import token_files
from edgeloom.llm.queries import QUERIES
from edgeloom.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
ENCODER = token_files.PieceEncoder(PATH)


def brute(rows):
    at, out = 0, []
    for d, t in rows:
        ids = np.array([*PLAIN.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\x0c\x1c\x85\xa0  　'.,aAéß9!<|>"),
                         st.characters(codec="utf-8"))))
def test_pieces_give_the_ids_of_the_whole_text(text):
    ids = np.frombuffer(ENCODER.encode(text), "<u4").tolist()
    assert ids == PLAIN.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 5, 8, 11, 16, 17, 24, 32])
def test_packing_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 10_000, dtype=np.uint64).astype(np.uint32)
    ends = np.array([0, 1, 4096, 4097, 9000, 10_000])
    out = io.BytesIO()
    token_files.write_file(out, [3, None, 5, 6, 7, 8], ends, ids, bits)
    assert len(out.getvalue()) < 300 + 10_000 * bits / 8 + 100
    out.seek(0)
    file = token_files.TokenFile(out)
    assert file.doc_ids == [3, None, 5, 6, 7, 8]
    for i in (5, 0, 3, 1, 4, 2):
        start = ends[i - 1] if i else 0
        assert file.document(i).tolist() == ids[start:ends[i]].tolist()
    assert file.ids(4000, 8300).tolist() == ids[4000:8300].tolist()


def test_bits():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    expected = brute([(r["doc_id"], r["text"]) for r in docs])
    assert rows_of(QUERIES["op5_token_files"](spark, sf_dir)) == expected


def test_awkward_rows_and_many_small_files(spark, monkeypatch):
    rows = [r for r in awkward() if r[0] != 8] + [(None, "second of no id")]
    docs = clashing(frame(spark, rows))
    found = rows_of(token_files.token_report(docs, PATH))
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    assert len(found) == len(rows)
    for d, start, n, crc in found:
        if d is not None:
            ids = np.array([*PLAIN.encode(texts[d] or "", add_special_tokens=False).ids, 0], "<u4")
            assert (n, crc) == (len(ids), zlib.crc32(ids.tobytes()))
    spans = sorted((s, s + n, -1 if d is None else d) for d, s, n, _ in found)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert [d for *_, d in spans] == sorted(d for *_, d in spans)
    assert token_files.token_report(frame(spark, []), PATH).collect() == []


def test_repeated_ids(spark):
    """Rows of one id follow each other, each with its own text."""
    rows = [(8, "one text"), (8, "another  text"), (8, "one text"), (7, None), (9, "x")]
    found = rows_of(token_files.token_report(frame(spark, rows), PATH))
    own = {t: np.array([*PLAIN.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for _, t in rows}
    expected = sorted((d, len(own[t]), zlib.crc32(own[t].tobytes())) for d, t in rows)
    assert sorted((d, n, crc) for d, _, n, crc in found) == expected
    spans = sorted((s, s + n, d) for d, s, n, _ in found)
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert [d for *_, d in spans] == [7, 8, 8, 8, 9]


def test_files_are_read_in_many_tasks(spark):
    path = scratch_path(spark, "token-test")
    files = token_files.write_tokens(frame(spark, [(i, f"text {i}") for i in range(50)]), PATH, path)
    read = token_files.read_tokens(files, path)
    assert read.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert read.count() == 50


def test_very_long_texts(spark):
    rng = np.random.default_rng(4)
    words = [f"word{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(words, 900_000)), "x" * 1_000_000, " \n".join(rng.choice(words, 200_000))]
    rows = list(enumerate(texts))
    assert rows_of(token_files.token_report(frame(spark, rows), PATH)) == brute(rows)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 7)
    encoder = token_files.PieceEncoder(PATH)
    for text in ("a b c d e f g h a b", "x y z", "", "a b c  d\n\ne f", " ".join(map(str, range(50))), "a x 49"):
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == PLAIN.encode(text, add_special_tokens=False).ids
