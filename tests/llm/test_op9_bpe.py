import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from helpers import EXTRA, awkward, frame
from ledgerline.llm import op9_byte_bpe as op


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def pair(request):
    ranks = op.read_ranks(public_tokenizers.path(request.param))
    return op.build_model(ranks), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(1)
    pool = "abc ABC  \n\t\r'stve0123456789.,!?éäßñ漢字かな🙂\u0301\u200b\u00a0\x00<|endoftext|>"
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 400))) for _ in range(150)] + ["a" * 30_000, " " * 5_000, "<|endoftext|>", "▁", "Thorerentsh inthe"]


def test_same_ids_as_the_reference_library(pair):
    model, reference = pair
    codec = op.Codec(model, public_tokenizers.PATTERN, remembered=50)
    for t in texts():
        ids = np.frombuffer(codec.encode(t), "<u4").tolist()
        assert ids == reference.encode_ordinary(t)
        assert codec.decode(np.array(ids, "<u4").tobytes()) == t.encode()


def test_tables(spark, pair):
    model, reference = pair
    rows = awkward()
    docs = frame(spark, rows)
    got = op.digests(docs, model).collect()
    body = {r[0]: r[1] or "" for r in rows}
    assert len(got) == len(rows)
    for r in got:
        ids = reference.encode_ordinary(body[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(body[r["doc_id"]].encode()).hexdigest()
        assert all(r[c] == f"{c}-{r['doc_id']}" for c in EXTRA)
    back = op.decode(op.encode(docs, model), model).collect()
    assert all(bytes(r["decoded"]).decode() == body[r["doc_id"]] for r in back)
    assert op.digests(frame(spark, []), model).count() == 0


def test_bad_vocabularies_are_refused():
    with pytest.raises(ValueError):
        op.build_model({b"a": 0})
    with pytest.raises(ValueError):
        op.build_model({b"a": 0, b"b": 2})
