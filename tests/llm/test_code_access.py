"""Direct access to many ids at once, and chunks of texts that are coded where they stand."""

import numpy as np
import public_tokenizers
import pytest

from duebook.llm.shared import CachedEncoder
from duebook.llm.token_codes import Codes


@pytest.mark.parametrize("bits", [8, 16])
def test_many_places_at_once(bits):
    r = np.random.default_rng(3)
    ids = r.integers(0, 2**32, 6_000, dtype=np.uint32) >> r.integers(0, 32, 6_000).astype(np.uint32)
    codes = Codes(Codes.encode(ids, bits))
    places = np.concatenate((np.arange(6_000), [0, 5_999, 511, 512, 4_096]))
    assert codes.take(places).tolist() == ids[places].tolist()
    assert [codes[i] for i in range(500, 530)] == codes.take(np.arange(500, 530)).tolist()
    assert len(codes.take(np.zeros(0, np.int64))) == 0
    for outside in (-1, 6_000):
        with pytest.raises(IndexError):
            codes.take(np.array([0, outside]))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_texts_of_a_batch_keep_their_ids(name):
    texts = ["one two\nthree", None, "four", "", "don't stop\nnow 12-ab", "a", "\u00fcber caf\u00e9, x", "  odd  text", "one two\nthree"]
    encoder = CachedEncoder(public_tokenizers.path(name))
    alone = [encoder._ids(t).tolist() if t else [] for t in texts]
    assert [ids.tolist() for ids in encoder.encode_all(texts)] == alone
