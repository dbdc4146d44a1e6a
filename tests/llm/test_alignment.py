"""Alignment against a plain walk over the libraries' own tokens of whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from orefold.llm import alignment, encoding

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
VOCABULARY = encoding.vocabulary(PATH_A)
with open(PATH_B, "rb") as file:
    MODEL = file.read()


def whole_tokens(texts):
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    shown = {}
    extra = 256
    for i in range(256):
        if 33 <= i <= 126 or 161 <= i <= 172 or 174 <= i <= 255:
            shown[chr(i)] = i
        else:
            shown[chr(extra)] = i
            extra += 1
    for text in texts:
        if not text:
            yield None
            continue
        whole = (" " + text).encode()
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False), b.encode(text)
        spelled_a = [bytes(shown[c] for c in t) for t in ids_a.tokens]
        names = b.id_to_piece(ids_b)
        spelled_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, names, strict=True)]
        ok = b"".join(spelled_a) == whole == b"".join(spelled_b)
        yield (list(zip(ids_a.ids, spelled_a, strict=True)), list(zip(ids_b, spelled_b, strict=True))) if ok else None


def groups_of(a, b):
    ends_a, ends_b = np.cumsum([len(s) for _, s in a]), np.cumsum([len(s) for _, s in b])
    common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    out, lo = [], 0
    for end in common:
        out.append(([i for (i, _), e in zip(a, ends_a, strict=True) if lo < e <= end], [i for (i, _), e in zip(b, ends_b, strict=True) if lo < e <= end]))
        lo = end
    return out


def brute(rows):
    found = []
    for (i, _), tokens in zip(rows, whole_tokens([t for _, t in rows]), strict=True):
        found.append((i, None) if tokens is None else (i, (len(tokens[0]), len(tokens[1]), groups_of(*tokens))))
    held = Counter()
    for _, f in found:
        held.update({(x, y) for a, b in (f[2] if f else []) for x in a for y in b})
    best = defaultdict(int)
    for (x, _), c in held.items():
        best[x] = max(best[x], c)
    out = []
    for i, f in found:
        if not f:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups = f
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out.append((i, n_a, n_b, len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), digest))
    return sorted(out, key=repr)


ODD = [
    " two  spaces", "ends with one ", "ends with two  ", " ", "  ", "\n", "tab\tnew\nline \n x", "a\r\nb  ", "Ünï ﬁ ①", "café x  y 　 z",
    "中文 émoji \U0001f600\U0001f600 \U0001f469‍\U0001f52c", "<|endoftext|> x </s><s> <unk> <0x41>", "▁foo bar", "\x00a \x7f b", "it's WE'LL 'tis 12345 3.14",
    "x" * 3000, "ab" * 700 + " " + "  q", "A b", "﻿ mark ​ zero",
]


@pytest.mark.parametrize(("block", "row", "long", "known"), [(6 << 20, 256, 4096, 400_000), (3000, 3, 2, 50)])
def test_like_brute_force(monkeypatch, spark, docs, given, block, row, long, known):
    for name, value in (("BLOCK_TEXT", block), ("ROW_STRETCHES", row), ("LONG_GROUP", long), ("KNOWN", known)):
        monkeypatch.setattr(alignment, name, value)
    rows = [(i, t) for i, t, *_ in given if t is None or len(t) < 20_000]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, None)]
    rng = random.Random(4)
    letters = [" ", " ", " ", "\n", "a", "B", "é", "7", "'s", ".", " ", "the", "字", "\U0001f600", "\t"]
    rows += [(2000 + i, "".join(rng.choices(letters, k=rng.randint(1, 40)))) for i in range(150)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, block string, `key` int").repartition(3)
    out = alignment.align(table, VOCABULARY, MODEL).collect()
    assert sorted(map(tuple, out), key=repr) == brute(rows)


def test_very_long_text(docs, given):
    text = next(t for _, t, *_ in given if t and len(t) > 100_000)
    known = alignment.Stretches(VOCABULARY, MODEL)
    import pyarrow as pa

    made = alignment.align_block(pa.array([text.encode(), b"", b"a b"], pa.large_binary()), known)
    a, b = next(iter(whole_tokens([text])))
    cuts = set(np.cumsum([len(s) for _, s in a]).tolist()) & set(np.cumsum([len(s) for _, s in b]).tolist())
    assert made["n_a"].tolist() == [len(a), 0, 2] and made["n_b"].tolist()[:2] == [len(b), 0] and made["n_groups"][0] == len(cuts)


def test_empty_table(empty):
    out = alignment.align(empty, VOCABULARY, MODEL)
    assert out.count() == 0 and out.columns[0] == "doc_id"
