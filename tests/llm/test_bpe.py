import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from opinio.llm.bpe import ByteBpe, encode_digests, encode_documents, read_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
BPE = ByteBpe(read_ranks(PATH), PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})


def ids(text):
    return np.frombuffer(BPE.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abcdeéö ñ'st12 \t\n\x0b\x1c\x1f\x85\u00a0\u2028\u3000.", max_size=60)))
def test_same_ids_as_the_reference_tokenizer(text):
    assert ids(text) == REFERENCE.encode_ordinary(text)
    assert BPE.decode(BPE.encode(text)) == text.encode()


def test_long_matches_and_long_texts():
    rng = np.random.default_rng(1)
    word = "".join(rng.choice(list("etaoinshr"), 3000))
    assert ids(word) == REFERENCE.encode_ordinary(word)
    text = "the quick fox é " * 80_000
    assert len(text) > 1 << 20
    assert ids(text) == REFERENCE.encode_ordinary(text)
    spaces = " " * 5000 + "x"
    assert ids(spaces) == REFERENCE.encode_ordinary(spaces)


def test_remembered_matches_stay_bounded(monkeypatch):
    from opinio.llm import bpe

    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own = ByteBpe(read_ranks(PATH), PATTERN)
    for text in ("alpha beta gamma delta epsilon", "alpha zeta"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == REFERENCE.encode_ordinary(text)
        assert len(own) <= 3


def test_documents_nulls_repeats_and_other_columns(spark):
    rows = [(1, None, 7), (None, "a b", 8), (2, "", 9), (2, "", 9), (3, "Ça  va?\n", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted(encode_digests(docs, PATH, PATTERN).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [1, 2, 2, 3, None]
    for r, text in zip(got, ["", "", "", "Ça  va?\n", "a b"], strict=True):
        want = REFERENCE.encode_ordinary(text)
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_documents(docs.limit(0), PATH, PATTERN).count() == 0
    assert {bytes(r.decoded) for r in encode_documents(docs, PATH, PATTERN).collect()} == {b"", b"a b", "Ça  va?\n".encode()}
