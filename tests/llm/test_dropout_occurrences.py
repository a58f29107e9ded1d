"""op2 cuts every occurrence of a word for itself, each merge skipped with the same chance."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

from rallyframe.llm import dropout


@pytest.fixture(scope="module")
def vocabulary():
    return dropout.Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def cuts(vocabulary, codec, doc_ids, text):
    """The segmentations of each word of the texts, all alike."""
    out = []
    for ids in dropout.encode_array(codec, doc_ids, pa.array([text] * len(doc_ids))):
        words, space = [], b" "
        for i in ids.tolist():
            if vocabulary.bytes_of[i].startswith(space):
                words.append([])
            words[-1].append(i)
        out.append([tuple(w) for w in words])
    return out


def test_variation_grows_with_occurrences(vocabulary):
    codec = dropout.DropoutCodec(vocabulary, 0.1, 1)
    (one,) = cuts(vocabulary, codec, [7], "international " * 400)
    assert len(set(one[:-1])) > 8
    firsts = {c[0] for c in cuts(vocabulary, codec, list(range(400)), "international")}
    assert len(firsts) > 8


def one_by_one(vocabulary, dropout_, key, doc_id, text):
    """Ids by an agenda for each word, with the hash written out."""
    import re

    import xxhash

    full = 0xFFFFFFFFFFFFFFFF

    def mixed(h):
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            h = (h ^ h >> 33) * factor & full
        return h ^ h >> 33

    owner = xxhash.xxh64_intdigest(repr(doc_id).encode(), key)
    out = []
    for n, word in enumerate(re.findall(r" +[^ ]*", " " + text if text else "")):
        own = mixed((owner + n * 0x9E3779B97F4A7C15) & full)
        skipped = lambda place, piece: mixed(own ^ dropout._salt(place, piece)) >> 32 < int(dropout_ * (1 << 32))  # noqa: E731,B023
        cut = vocabulary.segment([int(vocabulary.symbols[ord(c)]) for c in word], skipped)
        for _, symbol in cut:
            out += [symbol] if symbol < vocabulary.size else [int(vocabulary.byte_id[b]) for b in chr(symbol - vocabulary.size).encode()]
    return out


def test_words_together_equal_words_one_by_one(vocabulary):
    some = ["international markets  and a▁b 漢字 x", "", None, "markets markets", "   ", " lead", "y" * 70 + " international" * 9, "o", "\0 nul"] * 30
    for share in (0.0, 0.1, 0.5):
        whole = dropout.encode_array(dropout.DropoutCodec(vocabulary, share, 1), list(range(len(some))), pa.array(some))
        for i, text in enumerate(some):
            assert whole[i].tolist() == one_by_one(vocabulary, share, 1, i, text)
            assert vocabulary.decode(whole[i].tolist()) == (text or "")


def test_share_of_skipped_merges(vocabulary):
    rnd = random.Random(3)
    symbols = [int(vocabulary.symbols[ord(c)]) for c in " of"]
    plain = vocabulary.segment(symbols)
    want = sum(vocabulary.segment(symbols, lambda place, piece: rnd.random() < 0.1) == plain for _ in range(20000)) / 20000
    (one,) = cuts(vocabulary, dropout.DropoutCodec(vocabulary, 0.1, 1), [7], "of " * 20000)
    assert 0.8 < want < 1
    assert abs(sum(w == tuple(s for _, s in plain) for w in one[:20000]) / 20000 - want) < 0.015


def test_long_words_are_cut_as_short_ones(vocabulary, monkeypatch):
    some = pa.array(["international markets"] * 50)
    short = dropout.encode_array(dropout.DropoutCodec(vocabulary, 0.3, 1), list(range(50)), some)
    monkeypatch.setattr(dropout, "LONGEST", 3)
    long = dropout.encode_array(dropout.DropoutCodec(vocabulary, 0.3, 1), list(range(50)), some)
    assert [x.tolist() for x in short] == [x.tolist() for x in long]
