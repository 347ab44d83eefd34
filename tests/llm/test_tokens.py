"""Token files and packing against whole-text encoding, exact round trips and brute force."""

import json
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakelayer.llm import packing, queries, tokenbin
from lakelayer.llm.pieces import TextEncoder

SF = "/root/testdata/sf0.001"
FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ENC = {f: TextEncoder(P.path(f)) for f in FILES}
ODD = ["", " ", "\n", "a\n\nb", "a\n\n\nb", "a \n b", "x  y", "don't stop.\n", "\tTab", "é́ ß ÿ Ā", "日本 語", "<|endoftext|> a", "a.,b!? 12,3", "\x00a \x1f b", "Straße ÇA, 'll it's", "😀 ok.", "a\n", "\na", "İ ı ſ ŉ"]


def ids_of(file, text):
    return np.asarray(ENC[file].tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("file", FILES)
@pytest.mark.parametrize("text", ODD)
def test_pieces_equal_whole_text(file, text):
    assert ENC[file].encode(text) == ids_of(file, text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abÉßt' .,!\n-*1<|>×İ $"), max_size=40))
def test_pieces_equal_whole_random(text):
    for file in FILES:
        assert ENC[file].encode(text) == ids_of(file, text)


ADDED = ["one <|endoftext|> two", "one<|startoftext|>two", "<|endoftext|>", "a<|endoftext|><|endoftext|> b\nc", "<|ENDOFTEXT|> <|endoftext |>", "x <|startoftext|> y <|endoftext|>.", "日本 <|endoftext|>  z"]


@pytest.mark.parametrize("file", FILES)
def test_added_tokens_as_a_fresh_tokenizer(file):
    fresh = Tokenizer.from_file(P.path(file))
    for text in ADDED + ODD:
        assert ENC[file].encode(text) == np.asarray(fresh.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
    ends = {"word_bpe_49k.json": 49407, "byte_bpe_50k.json": 50256}
    assert ends[file] in np.frombuffer(ENC[file].encode(ADDED[0]), "<u4")


def test_tokens_of_the_normalized_text(tmp):
    with open(P.path(FILES[0]), encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"][-1].update(content="end of text", normalized=True, special=False)
    file = f"{tmp}/t.json"
    with open(file, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    own, fresh = TextEncoder(file), Tokenizer.from_file(file)
    for text in ["an end of text.", "an END of\n text", "end, of text"]:
        assert own.encode(text) == np.asarray(fresh.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, start string, ids string")


ROWS = [(5, "one two", "x", "y"), (None, "null id", None, "y"), (3, None, "x", None), (4, "", "x", "y"), (9, "long word " * 3000, "x", "y"), (5, "one two", "x", "y"), (7, "tail", "x", "y")]


def test_token_files_round_trip(spark):
    folder = tokenbin.write(docs(spark, ROWS), P.path(FILES[0]), end_id=2)
    got = sorted(tokenbin.read(spark, folder).collect(), key=lambda r: r.start)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0]))
    assert [r.doc_id for r in got] == [r[0] for r in order]
    at = 0
    for r, (_, text, *_x) in zip(got, order):
        want = ids_of(FILES[0], text or "") + b"\x02\0\0\0"
        assert (bytes(r.ids), r.start, r.n_tokens) == (want, at, len(want) // 4)
        at += len(want) // 4


def test_token_files_empty(spark):
    assert tokenbin.read(spark, tokenbin.write(docs(spark, []), P.path(FILES[0]), end_id=2)).count() == 0


def test_op1_over_table(spark):
    rows = sorted(queries.op1_token_files(spark, SF).collect(), key=lambda r: r.doc_id)
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    at = 0
    for r in rows:
        want = ids_of(FILES[0], texts[r.doc_id] or "") + b"\x02\0\0\0"
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want) // 4, zlib.crc32(want))
        at += len(want) // 4
    assert len(rows) == len(texts)


def check_packing(rows, texts, capacity=2048):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc_id, text in texts.items():
        want = ids_of(FILES[1], text or "") + b"\x01\0\0\0"
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want) // 4
            assert r.ids_crc32 == zlib.crc32(want[4 * at:4 * (at + r.length)])
            at += r.length
        assert at == len(want) // 4
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_seq)


def test_op5_over_table(spark):
    rows = queries.op5_packing(spark, SF).collect()
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    n = check_packing(rows, texts)
    assert n <= sum(r.length for r in rows) / 2048 * 1.02 + 1


def test_op5_odd_rows(spark):
    unique = {r[0]: r for r in ROWS}
    check_packing(queries.packed(docs(spark, list(unique.values()))).collect(), {k: r[1] for k, r in unique.items()})
    assert queries.packed(docs(spark, ROWS)).filter("doc_id = 5").count() == 2
    assert queries.packed(docs(spark, [])).count() == 0


def test_sequences_hold_every_id(spark):
    pieces = packing.tokenise(docs(spark, ROWS), P.path(FILES[1]), end_id=1, capacity=64)
    seqs = packing.sequences(pieces, packing.place(pieces.drop("ids"), capacity=64)).collect()
    assert sorted(np.concatenate([np.frombuffer(s.ids, "<u4") for s in seqs])) == sorted(
        np.concatenate([np.frombuffer(ids_of(FILES[1], r[1] or "") + b"\x01\0\0\0", "<u4") for r in ROWS])
    )
    assert max(len(s.ids) for s in seqs) <= 256


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 300), max_size=30))
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 50)
    held = {}
    for count, pattern in patterns:
        assert sum(a * b for a, b in pattern) <= 50
        for length, times in pattern:
            held[length] = held.get(length, 0) + count * times
    assert held == histogram


def test_equals_piece_by_piece_packing():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 40, 500).tolist()
    histogram = {n: lengths.count(n) for n in set(lengths)}
    packs = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, p in enumerate(packs) if p + n <= 100]
        if fits:
            i = min(fits, key=lambda i: packs[i])
            packs[i] += n
        else:
            packs.append(n)
    got = sorted(sum(a * b for a, b in pattern) for count, pattern in packing.shortest_pack_first(histogram, 100) for _ in range(count))
    assert len(got) == len(packs) and sum(got) == sum(packs)


def test_one_file_system_for_spark_and_workers(spark, tmp):
    from pyarrow import fs as pafs

    from lakelayer.llm.common import filesystem, qualified

    assert qualified(spark, tmp).startswith("file:/") and qualified(spark, f"file:{tmp}") == qualified(spark, tmp)
    fs, path = filesystem(qualified(spark, tmp))
    assert isinstance(fs, pafs.LocalFileSystem) and path == tmp
    for uri in ("s3a://bucket/a b/c", "s3n://bucket/a b/c", "s3://bucket/a b/c"):
        fs, path = filesystem(uri)
        assert isinstance(fs, pafs.S3FileSystem) and path == "bucket/a b/c"
    with pytest.raises(ValueError):
        filesystem("/no/scheme")
    with pytest.raises(Exception, match="(?i)unrecognized|unknown|nosuch"):
        filesystem("nosuch://x/y")
    # A path without scheme is written and read where Spark resolves it.
    folder = tokenbin.write(docs(spark, ROWS), P.path(FILES[0]), end_id=2, out_dir=f"{tmp}/ids")
    assert folder == qualified(spark, f"{tmp}/ids") and tokenbin.read(spark, f"{tmp}/ids").count() == len(ROWS)
