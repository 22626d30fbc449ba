import hashlib
import random

import numpy as np
from edge import SF, clashing, documents, edge, none

from stray.llm import lexicon as X
from stray.llm.bpe import ChunkEncoder, byte_ranks, chunks, tokenizer, tokenizer_path

FILE, RANKS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken")
SIGNS = [" ", " ", "\n", "a", "b", "the", "'s", "<|endoftext|>", "é", "日", "1", "#", "\t", "\xa0", "\x85", "!", "ſ", "\x1f", "　", "👍"]


def odd_texts(n=1500):
    rnd = random.Random(3)
    return ["", "  ", "a  b", "x" * 3000, " " * 50 + "y", "don't I'll we've <|endoftext|>"] + [
        "".join(rnd.choice(SIGNS) for _ in range(rnd.randint(1, 40))) for _ in range(n)]


def digest(text):
    tok = tokenizer(FILE)
    ids = tok.encode(text, add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_both_encoders_equal_the_library(tmp_path):
    texts, tok, ranks = odd_texts(), tokenizer(FILE), byte_ranks(RANKS)
    lexicon = X.compile_lexicon([c.encode() for t in texts[:400] for c in chunks(t) if t and not c.isspace()], ranks)
    X.write_lexicon(lexicon, str(tmp_path / "l"))
    codec, other = X.Codec(X.map_lexicon(str(tmp_path / "l")), ranks), ChunkEncoder(FILE, RANKS)
    for text, ids in zip(texts, codec.encode(texts)):
        want = tok.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want and other.encode(text).tolist() == want
        assert codec.decode(ids) == tok.decode(want, skip_special_tokens=False)


def test_automaton_is_minimal_and_numbers_its_words():
    words = sorted({(a + b + c).encode() for a in ("in", "un", "re") for b in ("do", "go") for c in ("ing", "ings", "er", "")})
    auto = X.minimal_automaton(words)
    auto |= {"ends": None, "ids": None}
    assert X.numbers(auto, words).tolist() == list(range(len(words)))
    assert X.numbers(auto, [b"", b"in", b"indox", b"zz", b"indoings!"]).tolist() == [-1] * 5
    # Right languages: the distinct sets of suffixes are the states of the minimal automaton.
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    rights = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes}
    assert len(auto["final"]) == len(rights)


def test_empty_lexicon():
    ranks = byte_ranks(RANKS)
    codec = X.Codec(X.compile_lexicon([], ranks), ranks)
    assert codec.encode(["hello there"])[0].tolist() == tokenizer(FILE).encode("hello there").ids


def test_documents(spark):
    texts = {r.doc_id: r.text for r in documents(spark, SF).collect()}
    for r in X.encode_documents(documents(spark, SF), words=500).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == digest(texts[r.doc_id])


def test_edges(spark):
    out = X.encode_documents(edge(spark)).collect()
    assert len(out) == edge(spark).count()
    assert sorted(r.n_tokens for r in out)[:3] == [0, 0, 0]
    want = sorted(digest(r.text or "") for r in edge(spark).collect())
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == want
    assert X.encode_documents(none(spark)).count() == 0
    assert X.encode_documents(clashing(spark)).count() == len(out)


def test_many_pieces_at_once_equal_one_by_one():
    ranks, rnd = byte_ranks(RANKS), random.Random(8)
    table = X.PairTable(ranks)
    pieces = [rnd.randbytes(rnd.randint(1, 40)) for _ in range(500)] + [b" aaaaaaaaaaaaaaaa", b"a", b"\xff" * 31, " naïvetés".encode()]
    pieces += ["".join(rnd.choice(["th", "in", "er", "e", "Z", "é"]) for _ in range(rnd.randint(1, 9))).encode() for _ in range(1500)]
    assert X.merge_many(pieces, table) == [X.merge_long(p, ranks) for p in pieces]
    assert X.merge_many([], table) == []
    assert [len(p) for p in X.portions(["x" * X.AT_ONCE, "y", "z" * 5, "w" * X.AT_ONCE, ""])] == [1, 2, 2]
