"""Token counts and byte-level BPE against the libraries of the vocabularies."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from hazardflow.llm import merge_replay, token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pairs(frame, *names):
    return sorted((tuple(-1 if r[n] is None else r[n] for n in names) for r in frame.collect()))


def test_counts_equal_the_library(corpus):
    tokenizer = Tokenizer.from_file(JSON)
    rows = [(r.doc_id, r.text or "") for r in corpus.collect()]
    want = []
    for i, text in rows:
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        want.append((-1 if i is None else i, len(text.encode()), n, n > 512))
    got = token_counts.count_tokens(corpus, open(JSON).read())
    assert pairs(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want)


def test_the_frequent_table_does_not_change_counts(corpus, monkeypatch):
    one = pairs(token_counts.count_tokens(corpus, open(JSON).read()), "doc_id", "n_tokens")
    monkeypatch.setattr(token_counts, "COUNTED", 10)  # counters are halved all the time
    monkeypatch.setattr(token_counts, "FREQUENT", 2)
    assert pairs(token_counts.count_tokens(corpus, open(JSON).read()), "doc_id", "n_tokens") == one


def test_ids_equal_the_library_and_decode_to_the_text(corpus, library):
    tokens = merge_replay.read_ranks(RANKS)
    decoded = merge_replay.decode(merge_replay.encode(corpus, tokens, public_tokenizers.PATTERN), tokens)
    want = []
    for r in corpus.collect():
        text = r.text or ""
        ids = library.encode_ordinary(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        want.append((-1 if r.doc_id is None else r.doc_id, len(ids), digest, hashlib.sha256(text.encode()).hexdigest()))
    assert pairs(merge_replay.digests(decoded), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want)


def test_replay_equals_word_by_word(library):
    merges = merge_replay.Merges(merge_replay.read_ranks(RANKS), public_tokenizers.PATTERN)
    words = [w.encode() for w in ("a" * 500, "abab" * 90, "!" * 77, " " * 40, "ééé", "internationalisation", "x")]
    ids, counts = merges.replay(words)
    at = 0
    for word, n in zip(words, counts):
        assert ids[at : at + n].tolist() == merges.encode_word(word) == library._encode_single_piece(word)
        at += n


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    tokens = merge_replay.read_ranks(RANKS)
    assert merge_replay.digests(merge_replay.decode(merge_replay.encode(empty, tokens, public_tokenizers.PATTERN), tokens)).collect() == []
    assert token_counts.count_tokens(empty, open(JSON).read()).collect() == []


def test_unsupported_definitions_raise():
    with pytest.raises(ValueError):
        token_counts.special_strings(open(public_tokenizers.path("word_bpe_49k.json")).read())
