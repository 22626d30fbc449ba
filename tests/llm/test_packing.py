import zlib

import numpy as np
import pytest
from edge import SF, clashing, documents, edge, none

from stray.llm import bpe
from stray.llm import packing as P
from stray.llm.bpe import tokenizer, tokenizer_path


def brute(sizes, capacity):
    """The heuristic over single items: the largest dot product that fits, first by size order among equals."""
    left, bins, current, room = list(range(len(sizes))), {}, 0, capacity.copy()
    while left:
        fits = [i for i in left if (sizes[i] <= room).all()]
        if not fits:
            current, room = current + 1, capacity.copy()
            continue
        dots = {i: ((room / capacity) * (sizes[i] / capacity)).sum() for i in fits}
        best = max(dots.values())
        i = min((i for i in fits if dots[i] >= best - 1e-12), key=lambda i: (tuple(sizes[i]), i))
        bins[i], room = current, room - sizes[i]
        left.remove(i)
    return bins


def test_pack_follows_the_heuristic():
    rng = np.random.default_rng(4)
    for capacity in (np.array([100, 5, 60]), np.array([100, 50, 100])):
        tokens = rng.integers(1, 100, 80)
        sizes = np.stack([tokens, np.ones(80, int), np.minimum(rng.integers(0, 60, 80), tokens)], axis=1)
        bins, places = P.pack(sizes, capacity)
        used = np.stack([np.bincount(bins, sizes[:, d]) for d in range(3)], axis=1)
        assert (used <= capacity).all()
        want = brute(sizes, capacity)
        assert abs(int(bins.max()) - max(want.values())) <= 1
        for b in range(bins.max() + 1):
            assert sorted(places[bins == b]) == list(range((bins == b).sum()))
    with pytest.raises(ValueError):
        P.pack(np.array([[101, 1, 1]]), np.array([100, 5, 60]))
    assert len(P.pack(np.zeros((0, 3), int), np.array([1, 1, 1]))[0]) == 0


def check(docs, out, limits):
    tok = tokenizer(tokenizer_path("byte_bpe_50k.json"))
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(tok.encode(r.text or "", add_special_tokens=False).ids + [1])
    pieces, seqs = {}, {}
    for r in out.collect():
        pieces.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == want.keys()
    for doc, lists in want.items():
        if len(lists) == 1:
            ids, at = lists[0], 0
            for r in sorted(pieces[doc], key=lambda r: r.start):
                part = np.array(ids[r.start:r.start + r.length], "<u4")
                assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(part.tobytes())
                at += r.length
            assert at == len(ids)
        assert sum(r.length for r in pieces[doc]) == sum(map(len, lists))
    for rows in seqs.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(rows) <= limits.segments and sum(r.loss_tokens for r in rows) <= limits.loss_tokens
    return sum(len(x) for lists in want.values() for x in lists) / (limits.tokens * len(seqs))


def test_documents_pack_tightly(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    assert check(docs, P.pack_documents(docs), P.Limits()) > 0.985


def test_narrow_limits_and_edges(spark):
    limits = P.Limits(tokens=512, segments=3, loss_tokens=400)
    # A full piece alone exceeds the narrow loss limit, so cut shorter than the capacity.
    with pytest.raises(Exception):
        P.pack_documents(documents(spark), limits).collect()
    docs = edge(spark)
    check(docs, P.pack_documents(docs), P.Limits())
    assert P.pack_documents(none(spark)).count() == 0
    assert P.pack_documents(clashing(spark)).count() == P.pack_documents(docs).count()


def test_small_blocks_are_valid_too(spark):
    docs = documents(spark, SF)
    pieces = P.materialise(P.cut_documents(docs, P.Limits(), tokenizer_path("byte_bpe_50k.json"),
                                           tokenizer_path("byte_bpe_50k.tiktoken")), "t")
    out = P.pack_items(pieces, P.Limits(), block=50)
    check(docs.select(docs.doc_id.cast("string").alias("doc_id"), "text"), out, P.Limits())


def test_encoder_remembers_a_bounded_number_of_chunks(monkeypatch):
    path = tokenizer_path("byte_bpe_50k.json")
    encoder = bpe.ChunkEncoder(path, tokenizer_path("byte_bpe_50k.tiktoken"))
    monkeypatch.setattr(bpe, "REMEMBERED", 100)
    monkeypatch.setattr(bpe, "PORTION", 64)
    texts = [sign.join(f"  word{i}\n x{i * i}" for i in range(300)) for sign in ("", "\t", "日", bpe.MARK)]
    for text in texts:
        assert "".join(bpe.portions(text)) == text and len(list(bpe.portions(text))) > 50
        assert encoder.encode(text).tolist() == tokenizer(path).encode(text, add_special_tokens=False).ids
        assert len(encoder.known) <= (0 if text is texts[0] else 100)
