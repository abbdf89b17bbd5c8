"""Alignments against a token by token comparison of what the two libraries give."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corvane.llm import alignment, words
from corvane.llm.bpe import byte_alphabet

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SIGNS = [
    "it's", " 's", "\n\n a", "  \t b", "é è", "é", "12a 3", "日本 語", "😀👍", "<|endoftext|>", "<s>", "</s> ", "<unk>",
    "<0x41>", "▁", "aaaaaaa", " ", "   ", "\r\n", ");\r\n}", "\u0085", "\x1c", "　x", "\xa0", "the", " quick", "\n", "\0",
    " areaing", ".", ", ", "Ᲊ",
]


def mixed(n, seed):
    rng = random.Random(seed)
    made = ["".join(rng.choices(SIGNS, k=rng.randint(0, 25))) for _ in range(n)]
    return [*made, "", " ", "\n", "▁", "a" * 4000, "ab " * 3000, "the quick\n" * 400, "the quick", "the quick"]


class Slow:
    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        signs = byte_alphabet()
        self.a_bytes = {i: bytes(signs[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}

    def b_bytes(self, i):
        text = self.b.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if self.b.is_byte(i) else text.replace("▁", " ").encode()

    def align(self, text):
        """Ids, groups and links of a text."""
        if not text:
            return [], [], [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        sides = []
        for ids, spelled in ((a, self.a_bytes.get), (b, self.b_bytes)):
            at, spans = 0, []
            for i in ids:
                spans.append((i, at, at + len(spelled(i))))
                at = spans[-1][2]
            sides.append(spans)
            if b"".join(map(spelled, ids)) != (" " + text).encode():
                return [], [], [], []
        links = [(i, j) for i, a0, a1 in sides[0] for j, b0, b1 in sides[1][:] if a0 < b1 and b0 < a1]
        ends = sorted({s[2] for s in sides[0]} & {s[2] for s in sides[1]})
        groups = [[[], []] for _ in ends]
        for side in (0, 1):
            for i, _, end in sides[side]:
                groups[next(k for k, e in enumerate(ends) if e >= end)][side].append(i)
        return a, b, groups, links


def shown(groups):
    return ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)


@pytest.fixture(scope="module")
def slow():
    return Slow()


def test_batches_equal_the_libraries(slow):
    given = mixed(300, 1)
    made = alignment.Aligned(given, A, B)
    groups = made.groups()
    for k, text in enumerate(given):
        if len(text) > 3000:
            continue
        a, b, want, links = slow.align(text)
        assert groups[k].decode() == shown(want), repr(text)
        assert (made.n_a[k], made.n_b[k]) == ((len(a), len(b)) if want else (0, 0))
        assert made.n_links[k] == len(links) and made.n_groups[k] == len(want)
        of = made.link_doc == k
        assert Counter(zip(made.a[made.link_a[of]].tolist(), made.b[made.link_b[of]].tolist(), strict=True)) == Counter(links)


def test_stretches_and_slices_change_nothing(monkeypatch):
    given = mixed(60, 2)
    want = alignment.Aligned(given, A, B)
    monkeypatch.setattr(alignment, "STRETCH", 3)
    monkeypatch.setattr(words, "SLICE", 40)
    got = alignment.Aligned(given, A, B)
    assert got.groups() == want.groups()
    assert [x.tolist() for x in got.pairs()] == [x.tolist() for x in want.pairs()]


@pytest.mark.parametrize("block", [1, 1 << 25])
def test_align(spark, slow, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    given = [(k, t) for k, t in enumerate(t for t in mixed(60, 3) if len(t) < 3000)]
    given += [(500, None), (500, "the quick"), (501, "the quick it's"), (None, "the")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in given], "doc_id long, text string, block int, pairs int").repartition(4)
    got = Counter(tuple(r) for r in alignment.align(docs, A, B, with_groups=True).collect())
    made = [(key, *slow.align(text)) for key, text in given if key is not None]
    pairs = Counter(p for *_, links in made for p in set(links))
    best = defaultdict(int)
    for (a, _), n in pairs.items():
        best[a] = max(best[a], n)
    want = Counter()
    for key, a, b, groups, links in made:
        text = shown(groups)
        want[(
            key, len(a) if groups else 0, len(b) if groups else 0, len(groups), len(links),
            sum(pairs[p] == best[p[0]] for p in links), sum(pairs[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "", text,
        )] += 1
    assert got == want


def test_lockstep_on_numbers():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, rng.integers(1, n + 1)), n)) for _ in range(2))
        x, y, cut = alignment.lockstep(a, b, *alignment.stretches(a, b, np.array([0]), np.array([0])))
        begin = [np.append(0, e[:-1]) for e in (a, b)]
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if begin[0][i] < b[j] and begin[1][j] < a[i]}
        assert set(zip(x.tolist(), y.tolist(), strict=True)) == want and len(x) == len(want)
        assert sorted(a[x[cut]].tolist()) == sorted(set(a.tolist()) & set(b.tolist()))


def test_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(docs, A, B).collect() == []
