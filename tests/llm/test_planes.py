import struct
import zlib

import numpy as np
import pytest

from tests.llm.conftest import pairs
from tidewater.llm import planes
from tidewater.llm.shared import new_folder

NAME = "word_bpe_49k.json"


def expected(rows, name=NAME):
    from tokenizers import Tokenizer

    enc = Tokenizer.from_file(planes.tokenizer_path(name))
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = enc.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("n_planes,block", [(32, 1 << 16), (4, 100)])
def test_files_hold_the_library_ids(edge, docs, n_planes, block):
    both = docs.unionByName(edge.select(*docs.columns))
    got = planes.write_and_digest(both, planes=n_planes, block_ids=block).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(pairs(both))


def test_read_ids_and_no_documents(spark, none, edge):
    read = planes.read_ids(planes.write_ids(edge, new_folder(spark, "ids"))).collect()
    assert sorted((r["start"], zlib.crc32(r["ids"])) for r in read) == sorted((e[1], e[3]) for e in expected(pairs(edge)))
    assert planes.write_and_digest(none).count() == 0


@pytest.mark.parametrize("n_planes", [32, 4])
def test_planes_round_trip(n_planes):
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 1000):
        for top in (1, 2, 300, 70_000, 1 << 32):
            ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            assert (planes.join_planes(planes.split_planes(ids, n_planes), n) == ids).all()


def test_any_block_alone(spark, docs):
    manifest = planes.write_ids(docs, new_folder(spark, "ids"), block_ids=500).collect()
    reader = planes.ShardReader(manifest[0]["file"])
    whole = np.concatenate([ids for _, ids in planes.ShardReader(manifest[0]["file"])])
    assert (reader.block(3) == whole[1500:2000]).all() and reader.n_ids == len(whole)


def test_pieces_are_cut_where_tokens_end():
    import random

    random.seed(5)
    enc = planes.PieceIds(planes.tokenizer_path(NAME))
    parts = list("abcXYZéÉßç×÷Σσς'\"!.,;:$%…»«—_-0123<|>日本е́ ́İıſK½ﬁ 　 \x1c\x1f\x85 \n\t") + ["'s", "'t", "<|endoftext|>", "<|ENDOFTEXT|>", " "]
    for _ in range(3_000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 14)))
        ids = enc.encoder.encode(text, add_special_tokens=False).ids
        assert enc.encode([text.encode()], b"")[0] == struct.pack(f"<{len(ids)}I", *ids), text


def test_a_tokenizer_without_the_cuts_encodes_whole_texts(edge):
    """Byte-level BPE keeps the case and the spaces: its ids are the library's, too."""
    got = planes.write_and_digest(edge, tokenizer="byte_bpe_50k.json").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(pairs(edge), "byte_bpe_50k.json")
    assert planes.PieceIds.of(planes.tokenizer_path(NAME)).by_piece and not planes.PieceIds.of(planes.tokenizer_path("byte_bpe_50k.json")).by_piece
