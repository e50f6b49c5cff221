import random
from functools import cache

import pytest

from tests.llm.conftest import pairs
from tidewater.llm import spfst

NAME = "piece_bpe_32k.model"
SMALL = [("<unk>", 0.0, spfst.UNKNOWN), ("<s>", 0.0, spfst.CONTROL), *[(f"<0x{b:02X}>", 0.0, spfst.BYTE) for b in range(256)],
         *[(p, s, spfst.NORMAL) for p, s in [("a", -3.0), ("b", -3.0), ("▁", -2.0), ("ab", -4.0), ("aba", -5.5), ("▁a", -4.0), ("bb", -6.0), ("a▁b", -1.0), ("▁▁", -9.0)]]]


def least(fst, text):
    """The weight of the best path, by trying all."""
    text = fst.normalise(text)

    @cache
    def go(i):
        if i == len(text):
            return 0.0
        found = [fst.weights[p] + go(j) for j in range(i + 1, len(text) + 1) if (p := fst.ids.get(text[i:j])) is not None]
        if text[i] not in fst.ids:
            found.append(fst.fallback + go(i + 1))
        return min(found)
    return go(0)


@pytest.mark.parametrize("pieces", [NAME, SMALL, [p for p in SMALL if p[0] != "a▁b"]])
def test_shortest_paths(pieces):
    fst = spfst.transducer(pieces) if isinstance(pieces, str) else spfst.Transducer(pieces)
    rng = random.Random(3)
    letters = "ab  a\n\té日☃▁𝄞" if pieces is not NAME else "abcdetionsr  \n\t.éß日☃▁𝄞"
    for _ in range(800):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        ids = fst.encode(text)
        assert abs(fst.weight(ids) - least(fst, text)) < 1e-3, text
        assert fst.decode(ids) == text.replace("▁", " "), text


def test_without_byte_pieces_and_squeezed():
    fst = spfst.Transducer([p for p in SMALL if p[2] != spfst.BYTE], squeeze=True)
    assert fst.encode("  a   b ").tolist() == fst.encode("a b").tolist()
    assert fst.encode("☃")[-1] == fst.unknown


def test_library_reads_the_ids():
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=spfst.model_path(NAME))
    fst = spfst.transducer(NAME)
    for text in ("  two  spaces\nand a line", "naïve 日本 🜚 end ", "a"):
        assert lib.decode(fst.encode(text).tolist()) == text


def test_whole_texts(edge, docs, none):
    both = docs.unionByName(edge.select(*docs.columns))
    encoded = spfst.encode(both).collect()
    assert len(encoded) == both.count() and all(r["round_trip"] for r in encoded)
    assert all(r["n_pieces"] == len(r["ids"]) for r in encoded)
    back = spfst.decode(spfst.encode(both))
    assert sorted((str(d), t) for d, t in pairs(back)) == sorted((str(d), (t or "").replace("▁", " ")) for d, t in pairs(both))
    assert spfst.encode(none).count() == 0
