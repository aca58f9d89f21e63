import json
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, rans

TEXTS = [
    "", " ", "\n\n a", "a  b", "it's 's x 'll", "<|endoftext|>x<|endoftext|> y", "a b  　c", "ΑΣ Σ ΣΑ, İx ǅ", "a\tb\r\nc ", "x" * 5000, "é éx J̌ ǰ", "日本語 テスト。 12345 ½", "😀😀 a\x1cb",
    "don't we'Re FOO'S Bar. bAr, ö, Ö. ... !! a, b; c", "one two three " * 3000,
]


def noise(seed: int) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice("abc ABC é.,'\n\t 12ß漢") for _ in range(rng.randint(1, 200)))


ALL = TEXTS + [noise(i) for i in range(300)]


def test_pair_index_equals_the_library():
    path = bpe.vocabulary("byte_bpe_50k.json")
    own, library = bpe.PairIndexBPE(path), Tokenizer.from_file(path)
    expected = [library.encode(t, add_special_tokens=False).ids for t in ALL]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(ALL)] == expected
    assert [own.decode(ids) for ids in expected] == [library.decode(ids, skip_special_tokens=False) for ids in expected]


def test_small_caches_change_nothing():
    path = bpe.vocabulary("byte_bpe_50k.json")
    own, small = bpe.PairIndexBPE(path), bpe.PairIndexBPE(path)
    small.chunks, small.pretokens = bpe.Recent(3), bpe.Recent(2)
    assert [small.encode([t])[0] for t in ALL] == own.encode(ALL)


def test_chunks_equal_the_library():
    path = bpe.vocabulary("word_bpe_49k.json")
    own, library = bpe.LibraryBPE(path), Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<u2").tolist() for x in own.encode([t.encode() for t in ALL])] == [library.encode(t, add_special_tokens=False).ids for t in ALL]


def test_encode_decode_of_edges(spark, edges, nothing):
    path = bpe.vocabulary("byte_bpe_50k.json")
    texts = {r["doc_id"]: r["text"] or "" for r in edges.collect() if r["doc_id"] is not None}
    rows = bpe.encode_decode(edges, path).collect()
    assert len(rows) == edges.count() and all(r["decoded"] == texts[r["doc_id"]] for r in rows if r["doc_id"] is not None)
    assert bpe.encoding_digests(edges, path).count() == edges.count() and bpe.encoding_digests(nothing, path).count() == 0


@pytest.mark.parametrize("n", [1, 5, rans.LANES, rans.LANES + 1, 3 * rans.LANES * rans.SEGMENT_ROWS + 17])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 500).astype(np.uint16)
    shared = rans.Frequencies(np.bincount(ids, minlength=500))
    cut = n // 3
    payload = rans.encode_block([None, 2**60 + 1], [ids[:cut], ids[cut:]], shared)
    block = rans.Block(payload, shared)
    assert block.doc_ids == [None, 2**60 + 1] and block.counts.tolist() == [cut, n - cut]
    assert (block.ids() == ids).all()
    size = rans.LANES * rans.SEGMENT_ROWS
    last = len(block.segments) - 1
    assert (block.segment(last) == ids[last * size :]).all()  # from its checkpoint alone
    damaged = bytearray(payload)
    damaged[-1 if len(block.words) else 40] ^= 1
    with pytest.raises(ValueError):
        rans.Block(bytes(damaged), shared).ids()


def test_files_of_edges(spark, edges, nothing, tmp_path):
    path = bpe.vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [(r["doc_id"], r["text"] or "") for r in edges.collect()]
    encoded = [(d, library.encode(t, add_special_tokens=False).ids + [2]) for d, t in rows]
    encoded.sort(key=lambda x: (x[0] is not None, x[0] or 0))
    folder = str(tmp_path / "files")
    ids = rans.encode_ids(edges, path)
    rans.write_files(ids, folder, rans.frequencies(ids, rans.vocabulary_size(path)))
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rans.read_files(spark, folder).collect() if r["doc_id"] is not None)
    start, expected = 0, []
    for doc, own in encoded:
        if doc is not None:
            expected.append((start, doc, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert got == expected
    rans.write_files(rans.encode_ids(nothing, path), str(tmp_path / "none"), rans.Frequencies(np.ones(9)))
    assert rans.read_files(spark, str(tmp_path / "none")).count() == 0


ALONE = """
import json, sys
from tidemark.llm import rans
folder, files = sys.argv[1], sys.argv[2:]
print(json.dumps([[d, x.tolist()] for f in files for d, x in rans.read_file(folder, f)]))
"""


def test_a_folder_is_read_with_nothing_else_at_hand(spark, tmp_path):
    path = bpe.vocabulary("word_bpe_49k.json")
    docs = spark.createDataFrame([(i, f"text number {i} of some words " * (i % 7 + 1)) for i in range(200)], "doc_id long, text string").repartition(5)
    folder = str(tmp_path / "files")
    ids = rans.encode_ids(docs, path)
    rans.write_files(ids, folder, rans.frequencies(ids, rans.vocabulary_size(path)))
    expected = [[r["doc_id"], np.frombuffer(r["ids"], "<u2").tolist()] for r in ids.orderBy("doc_id").collect()]
    # by its files alone, in a process of its own
    files = sorted(p.name for p in (tmp_path / "files").glob("part-*.rans"))
    out = subprocess.run([sys.executable, "-c", ALONE, folder, *files], capture_output=True, text=True, check=True).stdout
    assert json.loads(out) == expected
    # and by a session that did not write it, in blocks
    rans.frequencies_of.cache_clear()
    rows = rans.read_files(spark.newSession(), folder, digest=False).orderBy("start").collect()
    assert [[r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()] for r in rows] == expected
    assert not list((tmp_path / "files").glob(".part*"))
    # another table is refused
    (tmp_path / "files" / "frequencies").write_bytes(rans.Frequencies(np.ones(49_408)).to_bytes())
    rans.frequencies_of.cache_clear()
    with pytest.raises(ValueError):
        list(rans.read_file(folder, files[0]))
