import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from tessera.llm import _bpe
from tessera.llm._bpe import cuts, load, pretokens, read_ranks
from tessera.llm.bpe import VOCABULARY, decode, digests, encode, op3

ODD = ["", " ", "\n\n  x", "it's we'll I'RE 'r", "a   b", "été 東京 123 ½", "x" * 5000, " " * 3000 + "y", "<|endoftext|>", "'" * 40, "é    z", "😀😀 a\x00b"]


def official(name):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(name), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("seed", range(6))
def test_stitching(seed):
    r = random.Random(seed)
    find = regex.compile(P.PATTERN).findall
    bpe = load(P.path(VOCABULARY))
    several = 0
    for _ in range(400):
        text = "".join(r.choices(["a", "b", " ", "'", "s", "ll", "re", "\n", "1", "!", "é", "   ", "aaaaaaaa", "      ", "e\u0301", "٣", "東"], k=r.randrange(80)))
        chunk, overlap = r.randrange(1, 20), r.randrange(1, 12)
        assert [x for part in pretokens(text, find, chunk, overlap) for x in part] == find(text)
        # chunks by themselves, joined at their seams
        if not text:
            continue
        edges, out, seam = cuts(text, chunk, overlap), b"", 0
        several += len(edges) > 1
        for k, (start, end) in enumerate(edges):
            lead, after = edges[k - 1][1] - start if k else 0, edges[k + 1][0] - start if k + 1 < len(edges) else -1
            ids, meet, heads, before = bpe.chunk(text[start:end], lead, after)
            out += ids[4 * before[heads.index(seam - start)] :]
            seam = start + meet
        assert out == b"".join(map(bpe.encode, find(text)))
    assert several > 100


def test_ids_and_round_trip(make, prose):
    texts = prose(seed=7) + ODD
    enc = official(VOCABULARY)
    rows = {r.doc_id: r for r in op3(make(texts)).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256) == want


def test_decode(make, prose):
    texts = prose(seed=8)
    got = {r.doc_id: bytes(r.decoded) for r in decode(encode(make(texts))).collect()}
    assert got == {i: (t or "").encode() for i, t in enumerate(texts)}


def test_long_texts_in_chunks(make):
    """Ids by chunks of several sizes, over rows that repeat and rows without doc_id."""
    r = random.Random(4)
    long = ["word's  été\n" * 20_000 + "z" * 200_000 + " end", "".join(r.choices("ab 1!\n'", k=30_000)), "=" * 100_000, "12 " * 9000, "x" * 5000, " " * 9000 + "y"]
    texts, ids = [*long, long[0], long[1], *ODD, None], [*range(len(long)), 0, None, *range(50, 50 + len(ODD)), None]
    enc = official(VOCABULARY)
    plain = {t: enc.encode_ordinary(t or "") for t in {*texts}}
    key = lambda x: (x[0] is None, *map(str, x))
    want = sorted(((i, len(plain[t]), hashlib.sha256(",".join(map(str, plain[t])).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in zip(ids, texts, strict=True)), key=key)
    for chunk, overlap in ((_bpe.CHUNK, _bpe.OVERLAP), (1000, 40), (100_000, 10)):
        assert sorted(map(tuple, digests(make(texts, ids), chunk=chunk, overlap=overlap).collect()), key=key) == want
    got = sorted(((x.doc_id, x.ids) for x in encode(make(texts, ids), chunk=2000, overlap=50).collect()), key=key)
    assert got == sorted(((i, plain[t]) for i, t in zip(ids, texts, strict=True)), key=key)
    assert load(P.path(VOCABULARY)).encode(long[0]) == b"".join(i.to_bytes(4, "little") for i in plain[long[0]])


def test_json_vocabulary_is_the_tokenizer():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    bpe = load(P.path("byte_bpe_50k.json"))
    for text in ODD:
        assert bpe.encode(text) == b"".join(i.to_bytes(4, "little") for i in t.encode(text, add_special_tokens=False).ids)
    assert len(read_ranks(P.path("byte_bpe_50k.json"))) == 50_256


def test_empty(make):
    assert op3(make([])).count() == 0
    assert [r.n_tokens for r in op3(make([None, None], [None, None])).collect()] == [0, 0]
