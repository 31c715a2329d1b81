"""Chunks that a Python worker has encoded serve its later tasks."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyspark

from duebook.llm import shared, token_codes

PATH = public_tokenizers.path("byte_bpe_50k.json")


class _Task:
    def partitionId(self):  # noqa: N802
        return 0


def _ids(texts):
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return [token_codes.Codes(s.column(6)[0].as_py()).decode().tolist() for s in token_codes._segments(PATH, 2)(iter([rows]))]


def test_tasks_of_a_worker_encode_a_chunk_once(monkeypatch):
    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(_Task))
    plain = shared._library(PATH)
    first = [" ".join(f"one{'x' * i} two" for i in range(50)), "three\nfour", None, ""]
    second = ["three two\nfour new", *first]
    sent, ids_of = [], shared.CachedEncoder._ids

    def counted(self, text):
        sent.append(text)
        return ids_of(self, text)

    monkeypatch.setattr(shared.CachedEncoder, "_ids", counted)
    for texts in (first, second, first):
        sent.clear()
        expected = [i for t in texts for i in [*(plain.encode(t, add_special_tokens=False).ids if t else []), 2]]
        assert _ids(texts) == [expected]
    assert sent == []
    # a text with odd white space goes to the library whole, each time
    assert _ids(["  one"]) == [[*plain.encode("  one").ids, 2]] and "  one" in sent


def test_chunks_are_held_in_few_bytes():
    encoder = shared.CachedEncoder(PATH)
    words = [f"w{'abcdefghij'[i % 10] * (1 + i // 10 % 7)}q{'klmnopqrst'[i // 70 % 10]}{'uvwxyzabcd'[i // 700 % 10]}" for i in range(7_000)]
    got = encoder.encode_all([" ".join(words)])[0]
    assert got.tolist() == shared._library(PATH).encode(" ".join(words)).ids
    assert len(encoder.known) > 6_000
    assert encoder.known.nbytes + encoder.packed.nbytes + encoder.ends.nbytes < 60 * len(encoder.known)


def test_rank_directories_at_their_steps():
    r = np.random.default_rng(8)
    for n in (1, 512, 1023, 1024, 1025, 5_000):
        ids = r.integers(0, 70_000, n).astype(np.uint32)
        for _, _, more, ranks in token_codes.Codes(token_codes.Codes.encode(ids)).levels:
            bits = np.unpackbits(more, bitorder="little")
            assert ranks.tolist() == [int(bits[: k * token_codes.RANK_STEP].sum()) for k in range(len(ranks))]


def test_chunks_of_one_hash_keep_their_ids(monkeypatch):
    """All chunks of a length share a hash here, so only their bytes tell them apart."""
    monkeypatch.setattr(shared, "_hashes", lambda chunks: np.diff(shared._parts(chunks)[0]).astype(np.uint64) // 2)
    encoder = shared.CachedEncoder(PATH)
    for text in ("one two six\nseven ten", "ten two one", "six\none eleven seventeen", "a of b", "one two six\nseven ten"):
        assert encoder.encode_all([text])[0].tolist() == shared._library(PATH).encode(text).ids
