"""Numpy and Python parts of the operators against plain models."""

import itertools
import math
import pickle

import numpy as np
import pytest

from tidewatch.llm import langid, neardup, packing, quality, sharding, tokens, topk, toxicity


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_rank_code_round_trip(n):
    rng = np.random.default_rng(n)
    ranks = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
    block = tokens.encode_ranks(ranks)
    assert (tokens.decode_ranks(block) == ranks).all()
    widths = np.where(ranks > 0xFFFFFF, 4, np.where(ranks > 0xFFFF, 3, np.where(ranks > 0xFF, 2, 1)))
    assert len(block) == 8 + -(-n // 4) + widths.sum()


def test_rank_code_rejects_other_bytes():
    with pytest.raises(ValueError):
        tokens.decode_ranks(b"nope\0\0\0\0")


def test_pieces_equal_the_library():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    enc = tokens.PieceEncoder(path, room=50)  # small, so that words beyond the room are met too
    assert enc.fast
    rng = np.random.default_rng(1)
    parts = ["a", "Éa", "don't", "we'LL", "12", "½", " ", "  ", "\n", "\n\n", "\t", "\xa0", "!", "'s", "ß", " ", "中", "🙂", "<|endoftext|>", "x_y", "\x1c", "\x85", "ŀ", "'", ".\n"]
    for _ in range(600):
        text = "".join(rng.choice(parts, rng.integers(0, 14)))
        want = enc.tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), enc.kind).tolist() == want, repr(text)


def _encoder(**sizes):
    import public_tokenizers

    return tokens.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"), **sizes)


def test_pieces_without_the_regex_equal_the_library():
    enc = _encoder(room=40, late=7)
    rng = np.random.default_rng(2)
    parts = ["word", "Éla", " ", " ", " ", "\n", "\n\n", "  ", "\t", "\r\n", "\x85", "\xa0", "\x1c", "\x00", "\x7f", "***", "$", "'", "'s", "n't", "-", "7", "½", "ª", "ɏ", "ɐ", "и", "中", "<|endoftext|>", "<|", "|>", "endoftext"]
    for _ in range(4000):
        text = "".join(rng.choice(parts, rng.integers(0, 9)))
        want = enc.tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), enc.kind).tolist() == want, repr(text)


def test_words_with_marks_need_no_regex():
    """the pieces of a plain word and the marks behind it are known without the regex, met once or beyond the room."""
    enc = _encoder(room=3, late=50)
    want = [enc.tok.encode(t, add_special_tokens=False).ids for t in ("Une école, vraiment***", "a lone blank.\nand lines?!")]
    met = []
    plain = enc.pieces
    enc.pieces = lambda text: met.append(text) or plain(text)
    for _ in range(2):
        got = [np.frombuffer(enc.encode(t), enc.kind).tolist() for t in ("Une école, vraiment***", "a lone blank.\nand lines?!")]
        assert got == want
    assert all(not any(c.isalpha() for c in text) for text in met), met


def test_pieces_beyond_the_room_are_split_once():
    enc = _encoder(room=2, late=20)
    met, plain = [], enc.split
    enc.split = lambda text: met.append(text) or plain(text)
    text = " ".join(f"wo{c}rd" for c in "abcdefgh")
    first, again = enc.encode(text), enc.encode(text)
    assert first == again and len(met) == len(set(met)) == 8
    assert len(enc.known) <= 2 and len(enc.known.recent) <= 20
    for k in range(100):
        enc.encode(f"other{k} words{k}")
    assert len(enc.known) <= 2 and len(enc.known.recent) <= 20


@pytest.mark.parametrize("top", [1, 256, 257, 1 << 16, (1 << 16) + 1, 1 << 24, (1 << 24) + 1, 1 << 32])
def test_blocks_of_each_width(top):
    rng = np.random.default_rng(top)
    for n in (0, 1, 3, 4, 5, 400):
        ranks = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
        ranks[: n // 2] %= 300
        if n:
            ranks[-1] = top - 1
        block = tokens.encode_ranks(ranks)
        sizes = [max(1, (int(r).bit_length() + 7) // 8) for r in ranks]
        assert block[8 + -(-n // 4) :] == b"".join(int(r).to_bytes(s, "little") for r, s in zip(ranks, sizes, strict=True))
        assert (tokens.decode_ranks(block) == ranks).all()


def test_mil_gradient_is_the_derivative():
    rng = np.random.default_rng(0)
    p = {"W": rng.normal(size=(5, 4)), "b": rng.normal(size=4), "V": rng.normal(size=(4, 3)), "U": rng.normal(size=(4, 3)), "w": rng.normal(size=3), "c": rng.normal(size=4), "d": rng.normal(size=1)}
    x, starts, y, w = rng.normal(size=(7, 5)), np.array([0, 2, 6]), np.array([0.0, 1.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        z = quality._forward(p, x, starts)[0]
        return (w * (np.log1p(np.exp(z)) - y * z)).sum() / w.sum()

    grad = quality._gradient(p, x, starts, y, w)
    for name, value in p.items():
        for at in itertools.islice(np.ndindex(value.shape), 8):
            old, eps = value[at], 1e-6
            value[at] = old + eps
            up = loss()
            value[at] = old - eps
            down = loss()
            value[at] = old
            assert math.isclose(grad[name][at], (up - down) / (2 * eps), rel_tol=1e-4, abs_tol=1e-7), name


def test_passages_cover_long_and_empty_texts():
    assert quality.passages(b"", 512).shape == (1, quality.PAIRS + quality.SHAPES)
    assert len(quality.passages(b"x" * 512 * 7, 512)) == 7
    assert len(quality.passages(b"x" * (512 * 7 + 1), 512)) == 8


def plain_bundle(text, dims):
    letters, last = [], True
    for ch in f" {text.lower()} ":
        if ch.isalpha():
            letters.append(ord(ch))
        elif not last or not letters:
            letters.append(32)
        last = not ch.isalpha()
    out = np.zeros(dims)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        v = [langid.letter_vector(x, dims).astype(int) for x in (a, b, c)]
        out += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    return out


def test_bundles_equal_the_plain_sum():
    texts = ["Der Hund, 12 Hunde!", "", "  ?? ", "aé  Ω", "x", "ab", " a\nb "]
    got, has = langid.Bundler(64).bundle(texts)
    for row, text in zip(got, texts):
        assert np.array_equal(row, plain_bundle(text, 64)), text
    assert has.tolist() == [True, False, False, True, True, True, True]


def nearest_by_brute_force(rows, query, ids, k, but=None):
    cos = np.round(rows.astype(float) @ query.astype(float), 6)
    if but is not None:
        cos[but] = 0
    return [(int(ids[i]), cos[i]) for i in sorted(range(len(rows)), key=lambda i: (-cos[i], ids[i])) if cos[i] > 0][:k]


@pytest.mark.parametrize("common", [0, 8, 400])
@pytest.mark.parametrize("topics", [1, 12])
def test_block_max_search_is_exact_and_skips(common, topics):
    rng = np.random.default_rng(5)
    n, terms = 700, 400
    topic = rng.integers(0, topics, n)
    # each topic has its own range of terms; a sixth of the rows are repeated, so that there are ties
    own = (np.arange(terms)[None, :] * topics // terms == topic[:, None]) | (rng.random((n, terms)) < 0.01)
    tf = rng.integers(1, 5, (n, terms)) * (rng.random((n, terms)) < 0.15) * own
    tf[600:] = tf[:100]
    tf[5] = 0
    rows = tf * (1 + rng.random(terms))
    rows = (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    y = rng.integers(0, 2, n)
    example, term = np.nonzero(rows)
    order = toxicity.layout(example, term, tf[example, term], rows[example, term], y)
    assert sorted(order.tolist()) == list(range(n))
    place = np.argsort(order)
    ids = rng.permutation(n)
    index = pickle.loads(pickle.dumps(toxicity.BlockMaxIndex(place[example], term, rows[example, term], y[order], ids[order], terms, common, 16)))
    for but in (False, True):
        found = index.search([(np.flatnonzero(r), r[r > 0]) for r in rows], 7, place if but else None)
        for q, (at, cos) in enumerate(found):
            want = nearest_by_brute_force(rows, rows[q], ids, 7, q if but else None)
            # a cosine on the edge of its sixth digit may be rounded to either side
            assert np.allclose(cos, [c for _, c in want], atol=2e-6) and len(at) == len(want), q
            if min(np.diff([-c for _, c in want]), default=1) > 4e-6 and len(want) < 7:
                assert index.ids[at].tolist() == [i for i, _ in want]
            assert (index.labels[at] == y[order][at]).all()
    assert index.visited + index.skipped == 2 * n * index.blocks
    if topics > 1:
        assert index.skipped > index.visited  # most blocks belong to other topics


def test_ties_of_neighbours_go_to_the_smaller_id():
    ids = np.array([9, 4, 7, 1, 8, 2])
    index = toxicity.BlockMaxIndex(np.arange(6), np.zeros(6, int), np.ones(6), np.zeros(6, int), ids, 1, 1, 2)
    at, cos = index.search([(np.array([0]), np.array([0.5]))], 3)[0]
    assert index.ids[at].tolist() == [1, 2, 4] and cos.tolist() == [0.5] * 3
    at, _ = index.search([(np.array([0]), np.array([0.5]))], 3, np.array([3]))[0]
    assert index.ids[at].tolist() == [2, 4, 7]
    assert [len(a) for a, _ in index.search([(np.zeros(0, int), np.zeros(0))], 3)] == [0]


def test_finder_counts_like_the_plain_terms():
    text = "Idiot! idiotic IDIOT, ökonomie ok idiot-free"
    terms = {t: i for i, t in enumerate(["idiot", "idiot-", "idiot-@2", "idiot@3", "idiot@2", "ökono-", "none"])}
    plain = toxicity.repeated(toxicity.words(text))
    assert toxicity.TermFinder(terms).find(text) == {i: plain[t] for t, i in terms.items() if t in plain}
    other = toxicity.TermFinder(terms).count(text)[2]
    assert sorted(other.tolist()) == sorted(n for t, n in plain.items() if t not in terms)
    assert toxicity.TermFinder(terms).find(None) == {}


def test_shingles_and_equal_words():
    make = neardup.Shingler(2)
    assert len(make.shingles(None)) == len(make.shingles(" \t\n")) == 0
    assert len(make.shingles("One")) == 1 and make.shingles("One") == make.shingles(" oNE ")
    assert len(make.shingles("a b a b")) == 2
    assert make.shingles("É b") != make.shingles("é b")  # only A-Z is lower-cased
    assert make.shingles("a\xa0b c") != make.shingles("a b c")[:1]


def test_bitmaps_never_hide_a_shared_member():
    rng = np.random.default_rng(4)
    for n in (1, 50, 900, 5000):
        a = np.unique(rng.integers(0, 2**63, n, np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], rng.integers(0, 2**63, n, np.uint64)]))
        x, y = (np.unpackbits(np.frombuffer(neardup.bitmap(s), np.uint8)).astype(bool) for s in (a, b))
        assert (x & ~y).sum() <= len(np.setdiff1d(a, b)) and (y & ~x).sum() <= len(np.setdiff1d(b, a))


def test_best_fit_packs_all_and_downsizes():
    rng = np.random.default_rng(2)
    lengths = [16, 32, 64]
    for costs in ([16, 32, 64], [20, 36, 68], [16, 20, 64], [1, 100, 1000]):
        sizes = rng.integers(0, 65, 200)
        bins, offset, caps = packing.pack(sizes, lengths, costs)
        for b in range(len(caps)):
            mine = sizes[bins == b]
            assert mine.sum() <= caps[b]
            fits = [c for c in zip(costs, lengths) if c[1] >= mine.sum()]
            assert caps[b] == min(fits)[1]
            spans = sorted(zip(offset[bins == b], mine))
            assert all(o + n == q for (o, n), (q, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    # a preferred size is only taken if it is cheaper in the end
    assert packing.pack([10, 10, 10], [16, 32, 64], [16, 32, 64])[2].sum() == 32


def test_products_stay_exact_beyond_doubles():
    q, r = np.array([[2.0**40, 3.0]]), np.array([[2.0**20, 1.0], [-(2.0**40), 1.0]])
    assert topk.products(q, r).tolist() == [[2**60 + 3, -(2**63)]]


def test_fences_bound_every_true_answer():
    rng = np.random.default_rng(9)
    ends = np.cumsum(rng.integers(1, 50, 300)).tolist()
    known = sorted({0, ends[-1], *rng.choice(ends, 20).tolist()})
    fences = sharding.Fences(known, [True] * (len(known) - 1))
    full = sharding.Fences([0, *ends], [False] * len(ends))
    assert fences.capacity(7, False) <= full.capacity(7, True) <= fences.capacity(7, True)
