import itertools
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tallyhouse.llm import packing
from tallyhouse.llm.queries import pack
from tallyhouse.llm.words import slices

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ODD = ["a  b  c\n\n d\u3000 x <|endoftext|> y  z it's 12 3\t4\r\n \u0085 q  ", "no\u00a0break \u00a0 x", "\u2028 a \u2003b", "é à\n\nü ", "x\x1f y\x0b z", "<|endoftext|>", " <|endoftext|> 's 'll", "日本 語 です"]


def ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def test_ids_are_those_of_the_tokenizer():
    rng = random.Random(1)
    texts = [None, "", *ODD, *["".join(rng.choice(" \n\tab1.é\u00a0\u2009漢<|") for _ in range(60)) for _ in range(300)]]
    for encoder in (packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))):
        flat, bounds = encoder.ids(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert flat[bounds[i] : bounds[i + 1]].tolist() == ids(t), t


def test_best_fill_is_optimal():
    rng = random.Random(2)
    for _ in range(200):
        lengths = [rng.randrange(1, 30) for _ in range(rng.randrange(0, 9))]
        capacity = rng.randrange(1, 60)
        taken = packing.best_fill(lengths, capacity)
        assert not Counter(taken) - Counter(lengths)
        best = max(s for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if (s := sum(c)) <= capacity)
        assert sum(n * k for n, k in taken.items()) == best


def test_every_id_is_packed_once(spark, documents, edge_cases):
    rows = [(i, t) for i, t in edge_cases if i not in (4, None)] + [(100 + i, t) for i, t in enumerate(ODD)]
    check(pack(documents(rows)).collect(), dict(rows))


def check(got, texts):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for i, of in pieces.items():
        want, at = np.array(ids(texts[i]), "<u4"), 0
        for r in sorted(of, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(want[at : at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    for of in sequences.values():
        at = 0
        for r in sorted(of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 2048 or at < 2048 and at & (at - 1) == 0


def test_repeated_and_null_keys_and_the_empty_table(documents):
    got = pack(documents([(4, "a b"), (4, "a b"), (None, "a b")])).collect()
    assert Counter(r.doc_id for r in got if r.start == 0) == {4: 2, None: 1}
    assert pack(documents([])).count() == 0


def test_a_worker_holds_little_beside_the_text():
    """Two workers share an executor with the JVM, so a slice's codes and ids are to stay far below 100 MB."""
    texts = pa.array([" ".join(f"w{(i * j) % 997}" for j in range(1600)) for i in range(1000)], pa.string())
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoder.ids(texts.slice(0, 20))
    tracemalloc.start()
    try:
        total = sum(len(encoder.ids(texts.slice(a, b - a))[0]) for a, b in slices(texts, packing.SLICE))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total > 2_000_000 and texts.nbytes > 7_000_000
    assert peak < 100e6, peak
