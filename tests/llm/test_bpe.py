import hashlib
import random

import pytest

from indicatrix.llm import bpe
from tests.llm.common import DOCS, corpus, frame

tokenizers = pytest.importorskip("tokenizers")
PATH = bpe.default_path()
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()

ODD = [
    "don't DON'T it's we'll I'd they've you're I'm 's'd ''s",
    "<|endoftext|>a<|startoftext|><|endoftext|> x <|ENDOFTEXT|> <|endoftext |>",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa a aa aaa aaaa aaaaa",
    "é É İstanbul ΣΣ σς ﬁ ẞ Å   x\u0085y\x1cz​",
    "你好 \U0001f600\U0001f680 ١٢ 1234567 3.14 Ⅷ กำ 한글 한",
    "!!!!!!!!!! ----- ===== ........ <</w> </w> w</w> a</w>b",
    "\x00\x01\x7f \x85 tab\tnew\nline\rfeed\x0b\x0c",
    "supercalifragilisticexpialidocious antidisestablishmentarianism zzzzqqqqxxxx 0xDEADBEEF A1b2C3d4",
    " ".join(chr(c) for c in range(33, 0x600)),
]


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def brute(rows):
    out = []
    for doc_id, text in [(r[0], r[1]) for r in rows]:
        ids = library(text)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        out.append((doc_id, len(ids), *digests))
    return sorted(out, key=str)


def letters(seed, n=60):
    """Texts of random letters, from few and from many."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kinds = rng.choice(["ab", "the rain", "abcdefghijklmnopqrstuvwxyz '", "aA1!éß 一", "".join(map(chr, range(32, 0x250)))])
        out.append((i, "".join(rng.choice(kinds) for _ in range(rng.randint(0, 300))), "en", "s", 0))
    return out


def test_query_against_the_library(spark):
    rows = letters(1) + [(100 + r[0], *r[1:]) for r in corpus(1, 30)] + [(300 + i, t, "", "", 0) for i, t in enumerate(ODD)]
    got = bpe.digest(frame(spark, rows))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    import pyarrow as pa

    vocabulary = bpe.Vocabulary(bpe.file_text(PATH))
    assert vocabulary.encoded(pa.array([text])).to_pylist() == [library(text)]


def test_walk_equals_merging():
    """Every piece alike: last tokens along a trie, and merging pair by pair."""
    vocabulary, rng = bpe.Vocabulary(bpe.file_text(PATH)), random.Random(3)
    pieces = {bytes(rng.choice(b"aabeinorst") for _ in range(rng.randint(1, 14))) for _ in range(3000)} | {b"a" * n for n in range(1, 60)}
    for piece, ids in vocabulary.encode_pieces(pieces).items():
        assert ids == vocabulary.merged((*piece[:-1], piece[-1] + bpe.END))


def test_borders_equal_merging():
    """Whether two tokens stay apart: by the parts at their border, and by merging all their symbols."""
    vocabulary, rng = bpe.Vocabulary(bpe.file_text(PATH)), random.Random(5)
    assert vocabulary.in_order
    some = [t for t, s in vocabulary.symbols.items() if all(x < bpe.END for x in s)]
    short = [t for t in some if len(vocabulary.symbols[t]) < 4 and set(vocabulary.symbols[t]) <= set(b"aeinort")]
    pairs = [(rng.choice(some), rng.choice(list(vocabulary.symbols))) for _ in range(4000)] + [(a, b) for a in short for b in short][:20000]
    stays = [vocabulary.stay(a, b) for a, b in pairs]
    assert stays == [vocabulary.merged(vocabulary.symbols[a] + vocabulary.symbols[b]) == [a, b] for a, b in pairs]
    assert 0 < sum(stays) < len(stays)


def test_forgetting_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 7)
    rows = letters(2, 30)
    assert sorted(map(tuple, bpe.digest(frame(spark, rows)).collect()), key=str) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, "some text", "", "", 0), (5, None, "", "", 0), (5, "", "", "", 0), (6, " \n", "", "", 0), (6, " \n", "", "", 0), (7, "long " * 50_000 + "x" * 20_000, "", "", 0)]
    assert sorted(map(tuple, bpe.digest(frame(spark, rows)).collect()), key=str) == brute(rows)
    assert bpe.digest(spark.createDataFrame([], DOCS)).count() == 0


def test_encode_and_decode(spark):
    rows = letters(4, 20)
    ids = bpe.encode(frame(spark, rows), PATH)
    assert {r["doc_id"]: r["ids"] for r in ids.collect()} == {r[0]: library(r[1]) for r in rows}
    assert {r["doc_id"]: r["text"] for r in bpe.decode(ids, PATH).collect()} == {r[0]: LIBRARY.decode(library(r[1]), skip_special_tokens=False) for r in rows}
    odd = spark.createDataFrame([(1, [320, None, -1, 10**6, 49407, 49406]), (2, None), (3, [])], "doc_id long, ids array<int>")
    want = LIBRARY.decode([320, 49407, 49406], skip_special_tokens=False)
    assert {r["doc_id"]: r["text"] for r in bpe.decode(odd).collect()} == {1: want, 2: "", 3: ""}


def test_other_kinds_of_files_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.file_text(public_tokenizers.path("byte_bpe_50k.json"))
