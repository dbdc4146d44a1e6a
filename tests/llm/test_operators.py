"""Each operator against brute force, on texts null, empty, long, tied and repeated."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orefold.llm import encoding, fingerprints, licences, mixing, near, outliers, quality, sequences, spans, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
VOCABULARY = encoding.vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def words(text):
    return WORDS.findall(text or "")


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- 1: toxicity -------------------------------------------------------------


def brute_segments(scores):
    """All maximal scoring segments by their definition: best of the rest, recursively."""
    best = max(
        ((sum(scores[a:b]), -a, -b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0,)
    )
    if best[0] <= 0:
        return []
    a, b = -best[1], -best[2]
    shift = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return [*brute_segments(scores[:a]), (a, b - 1, best[0]), *shift]


def test_segments():
    rng = np.random.default_rng(3)
    for _ in range(60):
        own = {int(i): float(rng.choice([3.25, 1.5, -0.75, 2.125])) for i in rng.choice(24, rng.integers(0, 10), replace=False)}
        at = sorted(own)
        found = toxicity.maximal_segments(at, [own[i] for i in at], 0.625)
        total = sum(s for _, _, s in found)
        expected = brute_segments([own.get(i, -0.625) for i in range(24)])
        assert total == pytest.approx(sum(s for _, _, s in expected))
        assert max((s for _, _, s in found), default=0) == max((s for _, _, s in expected), default=0)


def test_toxicity(spark, empty):
    rows = [(i, f"plain words number{i} here " * 5 + ("vile" if i % 4 == 0 else "") + " and more of them") for i in range(400)]
    rows += [(400, None), (401, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(found) == 402
    for i in range(400):
        assert (found[i].score >= 0.7) == (i % 4 == 0), i
    assert found[400].score == found[401].score < 0.5
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.fit(empty, labels.where("false")).scores == {}


# -- 2: licences -------------------------------------------------------------


def test_licences(spark, docs, empty):
    lines = {
        500: ("Some prose.\nLicensed under the Apache License, Version 2.0.\nMore.", ["apache-2.0"]),
        501: ("Released under the MIT License.", ["mit"]),
        502: ("This work is licensed under the GNU General Public License, version 3.", ["gpl-3.0"]),
        503: ("the version of the work is under the table", []),
        504: ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4.0"]),
    }
    more = spark.createDataFrame([(i, t) for i, (t, _) in lines.items()], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    model = licences.fit(every)
    found = {r.doc_id: r.families for r in licences.label(every, model).collect()}
    assert {i: found[i] for i in lines} == {i: f for i, (_, f) in lines.items()}
    assert all(not f for i, f in found.items() if i not in lines)
    assert licences.label(empty, model).count() == 0


def test_licences_inside_texts(spark, docs):
    prose = "the rain fell on the old town and people went home along the river while the lamps were lit "
    notices = {
        "apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "mit": "Released under the MIT License.",
        "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
        "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "bsd-3-clause": "Licensed under the BSD 3-Clause License.",
        "all-rights-reserved": "All rights reserved.",
    }
    model = licences.fit(docs.select("doc_id", "text"))
    rows, expected = [], {}
    for n, (family, notice) in enumerate(notices.items()):
        w = notice.split()
        wrapped = "\n".join("# " + " ".join(w[i : i + 4]) for i in range(0, len(w), 4))
        for i, text in enumerate((prose * 2 + notice + " " + prose * 2, prose * 300 + notice, prose + "\n" + wrapped + "\n" + prose)):
            rows.append((10 * n + i, text))
            expected[10 * n + i] = [family]
    rows.append((200, prose + notices["mit"] + " " + notices["apache-2.0"] + " " + prose))
    rows.append((201, prose + "free of charge to any person under the license of the work and its public rights " + prose))
    rows += [rows[0], (None, rows[0][1])]
    expected |= {200: ["apache-2.0", "mit"], 201: [], None: ["apache-2.0"]}
    found = {r.doc_id: r for r in licences.label(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert {i: r.families for i, r in found.items()} == expected
    assert found[0].n_lines == 2 and found[None].n_lines == found[10].n_lines == 1 and found[201].n_lines == 0


# -- 3: quality --------------------------------------------------------------


def test_quality(spark, docs, empty, labels, given):
    junk = spark.createDataFrame([(1000 + i, "###" * 5 + " $$$ %%% | " * 30) for i in range(20)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(junk)
    found = {r.doc_id: r for r in quality.select(every, labels).collect()}
    assert not any(found[1000 + i].kept for i in range(20))
    assert sum(found[i].kept for i in range(60)) > 40  # one text is longer than all others together here
    assert found[95].kept and found[95].log_weight == 0
    keys = sorted((r.key for r in quality.select(every, labels).collect()), reverse=True)
    for k in (1, 7, 40):
        assert sum(r.kept for r in quality.select(every, labels, k).collect()) == sum(x >= keys[k - 1] for x in keys)
    assert quality.select(empty, labels).count() == 0
    kept = quality.keep(docs, labels)
    chosen = sorted(r.doc_id for r in quality.select(docs, labels).collect() if r.kept)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == chosen


# -- 4: fingerprints ---------------------------------------------------------


def jaccard(a, b, k=fingerprints.SHINGLE):
    sets = []
    for t in (a, b):
        w = words(t.translate(LOWER))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1])) if any(sets) else 1.0


def test_fingerprints(docs, empty, given):
    found = {}
    for r in fingerprints.compare_with_edits(docs).collect():
        found.setdefault(r.doc_id, []).append(r)
    order = sorted(((i, t or "") for i, t, *_ in given), key=lambda x: x)
    errors = []
    for n, (i, text) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        r = next(r for r in found[i] if r.edited_sha256 == sha)
        assert r.n_chars == len(text)
        errors += [abs(r.near_edited - jaccard(text, edited)), abs(r.near_next - jaccard(text, following))]
    assert max(errors) < 0.2 and np.mean(errors) < 0.03
    assert len({r.fingerprint for i in (3, 90, 94) for r in found[i]}) == 1
    assert fingerprints.compare_with_edits(empty).count() == 0
    assert {tuple(r) for r in fingerprints.fingerprint(docs).collect()} == {(r.doc_id, r.fingerprint) for rs in found.values() for r in rs}


# -- 5: outliers -------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    w = words(text)
    at = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    marked = {j for i in range(len(w) - 7) if at[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(marked) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(marked), failed


def test_outliers(spark, docs, empty, given):
    odd = spark.createDataFrame([(2000, " ".join(["word#"] * 2 + [f"w{i}###%%%" for i in range(60)]), "en", "s1")], "doc_id long, text string, lang string, source string")
    names = ["doc_id", "text", "lang", "source"]
    found = outliers.judge(docs.select(names).unionByName(odd)).collect()
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found if r.doc_id != 2000)
    assert got == sorted((i, *brute_counts(t)) for i, t, *_ in given)
    assert not any(r.kept for r in found if r.base_failed or r.doc_id == 2000)
    assert all(r.kept for r in found if not r.base_failed and r.doc_id < 90)
    assert outliers.judge(empty).count() == 0


def test_outliers_by_one_statistic(spark, empty):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), int(rng.integers(3, 8))))
    text = lambda n: [word() for _ in range(n)]
    rows = [(i, " ".join(text(int(rng.integers(100, 400)))), "en", "s1") for i in range(300)]
    long = text(2_000)
    lines = [f"{word()} {word()} {word()} {word()}" for _ in range(300)]
    lines = [x for i, x in enumerate(lines) for x in ((x, lines[0]) if i % 2 else (x,))]  # a third of them repeated, no window of eight words
    odd = {
        1000: " ".join(long[:1420] + long[:580]),  # fails the base rules
        1001: "\n".join(lines),
        1002: " ".join(w + ("#" if i % 7 == 0 else "") for i, w in enumerate(long)),
        1003: " ".join(long[:1700] + long[:290]),
    }
    rows += [(i, t, "en", "s1") for i, t in odd.items()]
    found = {r.doc_id: r for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert found[1000].base_failed and not any(found[i].base_failed for i in (1001, 1002, 1003))
    assert not any(found[i].kept for i in odd)
    assert sum(found[i].kept for i in range(300)) >= 295
    assert outliers.consistency(0.75) == pytest.approx(1.486, abs=2e-3)


# -- 6 and 7: token ids ------------------------------------------------------


@pytest.fixture(scope="module")
def tokens(given):
    made = Tokenizer.from_str(VOCABULARY)
    ids = [made.encode(t or "", add_special_tokens=False).ids for _, t, *_ in given]
    return ids, [made.decode(i, skip_special_tokens=False) for i in ids]


def test_sequences(docs, empty, given, tokens):
    manifest = sequences.write(docs, VOCABULARY, end_id=2, length=64, rows=8)
    order = sorted(((i, n) for n, (i, *_) in enumerate(given)), key=lambda x: (x[0], np.array([*tokens[0][x[1]], 2], "<u2").tobytes()))
    start, expected = 0, []
    for i, n in order:
        ids = [*tokens[0][n], 2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, sequences.read(manifest).collect())) == sorted(expected)
    shard = manifest.orderBy("part").first()
    opened = sequences.Sequences(shard.file)
    flat = np.concatenate(list(opened.stream()))
    for i in (0, len(flat) // 64):
        ids, mask = opened[i]
        assert not ids.flags.owndata and not mask.flags.owndata and mask.dtype == bool
        assert len(ids) == len(mask) == 64 and (ids[mask] == flat[64 * i : 64 * i + 64]).all()
    assert sequences.read(sequences.write(empty, VOCABULARY, end_id=2)).count() == 0


def test_encoding(docs, empty, given, tokens):
    expected = Counter((r[0], np.array(ids, "<u4").tobytes(), text) for r, ids, text in zip(given, *tokens, strict=True))
    assert Counter((r.doc_id, bytes(r.ids), r.decoded) for r in encoding.encode(docs, VOCABULARY).collect()) == expected
    assert encoding.encode(empty, VOCABULARY).count() == 0


def test_decoding(spark, tokens):
    rows = spark.createDataFrame([(i, ids) for i, ids in enumerate(tokens[0][:4])] + [(9, None)], "n int, ids array<int>")
    assert [r.decoded for r in encoding.decode_ids(rows, VOCABULARY).orderBy("n").collect()] == [*tokens[1][:4], None]


# -- 8: mixing ---------------------------------------------------------------


def test_fit_is_best():
    rng = np.random.default_rng(1)
    for _ in range(40):
        lengths = np.unique(rng.integers(0, 30, 5))
        counts = rng.integers(1, 4, len(lengths))
        budget = int(rng.integers(0, 200))
        taken = mixing.fit(lengths, counts, budget)
        assert (taken >= 0).all() and (taken <= counts).all()
        total = int((lengths * counts).sum())
        assert int((lengths * taken).sum()) <= total
        if budget >= total:
            assert int((lengths * taken).sum()) == total


def test_shares():
    assert mixing.shares([100, 10, 0], [1, 2, 3]) == pytest.approx([80, 30, 0])
    assert mixing.shares([], []) == []


def test_mixing(docs, empty, given):
    found = mixing.copies(docs).collect()
    assert table(mixing.copies(docs)) == sorted(map(tuple, found), key=repr)
    sizes = Counter()
    for _, t, _, source, _ in given:
        sizes[source] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = dict(zip(order, mixing.shares([sizes[s] for s in order], [(1, 2, 3)[i % 3] for i in range(len(order))]), strict=True))
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
    largest = {s: max(len(words(t)) for _, t, _, x, _ in given if x == s) for s in sizes}
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in sizes)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter((r.doc_id, r.source, r.text) for r in mixed.collect())
    wanted = Counter()
    texts = defaultdict(list)
    for i, t, _, s, _ in given:
        texts[i, s].append(t)
    for r in found:
        wanted[r.doc_id, r.source, texts[r.doc_id, r.source][0]] += r.copies
    assert got == +wanted
    assert mixing.copies(empty).count() == 0 and mixing.mix(empty).count() == 0


# -- 9: spans ----------------------------------------------------------------


def brute_spans(rows):
    def units(text):
        out = []
        for line in re.split("\n", text or ""):
            held = []
            for w in WORDS.findall(line):
                held.append(w)
                last = ord(w[-1]) if ord(w[-1]) < 128 else 0
                if w[-1] in ".!?,;:" or (len(w.encode()) + last) % spans.MARKED == 0:
                    out.append(held)
                    held = []
            if held:
                out.append(held)
        return out

    distinct = sorted({(i, t or "") for i, t, *_ in rows})
    split = {x: units(x[1]) for x in distinct}
    seen, gone = set(), defaultdict(set)
    for x in distinct:
        s = split[x]
        for j in range(len(s)):
            end, n = j, 0
            while end < len(s) and n < spans.LEAST_WORDS:
                n += len(s[end])
                end += 1
            if n >= spans.LEAST_WORDS:
                run = tuple(map(tuple, s[j:end]))
                if run in seen:
                    gone[x] |= set(range(j, end))
                seen.add(run)
    return {x: [" ".join(w) for j, w in enumerate(split[x]) if j not in gone[x]] for x in distinct}, {x: len(gone[x]) for x in distinct}


def repeats(texts, n=50):
    """Texts that hold a window of n words which an earlier text holds, too."""
    seen, out = set(), set()
    for i, text in enumerate(texts):
        own = words(text)
        mine = {tuple(own[j : j + n]) for j in range(len(own) - n + 1)}
        if mine & seen:
            out.add(i)
        seen |= mine
    return out


def test_spans_wherever_they_stand(spark, empty):
    """Passages of over 50 words in mid-sentence, as one sentence, in sentences of a word or two."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 11)))
    prose = lambda n, stop: " ".join(word() + ("." if stop and i % stop == stop - 1 else "") for i in range(n))
    texts = []
    for g in range(40):
        passage = prose([70, 60, 55][g % 3], [0, 30, 2][g % 3])
        for _ in range(3):
            texts.append(f"{prose(37, 9)} {word()} {passage} {word()} {prose(41, 11)}")
    clean = [prose(150, 9) for _ in range(40)]
    rows = list(enumerate(texts + clean))
    out = {r.doc_id: r for r in spans.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len(repeats(texts)) == 80
    left = repeats([out[i].text for i in range(len(texts))])
    assert len(left) <= 4
    assert all(out[len(texts) + i].text == t for i, t in enumerate(clean))
    assert all(out[3 * g].text == texts[3 * g] for g in range(40))


def test_spans_sql(spark, docs):
    import duckdb
    from orefold.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    found = queries.op9_spans(spark, sf_dir)
    expected = con.sql(spans.ORACLE)
    assert sorted(found.columns) == sorted(expected.columns)
    assert sorted(tuple(r[c] for c in expected.columns) for r in found.collect()) == sorted(expected.fetchall())


def test_spans(docs, empty, given):
    kept, gone = brute_spans(given)
    found = spans.dedup(docs).collect()
    expected = Counter((i, " ".join(kept[i, t or ""]), gone[i, t or ""]) for i, t, *_ in given)
    assert Counter((r.doc_id, " ".join(words(r.text)), r.n_removed) for r in found) == expected
    assert any(r.n_removed for r in found)
    texts = {(i, t) for i, t, *_ in given}
    assert all((r.doc_id, r.text) in texts for r in found if not r.n_removed)
    assert spans.dedup_rows(docs).columns == docs.columns and spans.dedup(empty).count() == 0


# -- 10: near copies ---------------------------------------------------------


def brute_near(rows, k, percent):
    sets = []
    for _, t, *_ in rows:
        w = words((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    part = list(range(len(rows)))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both) and sets[j]:
                part[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return sorted((r[0], len(s), least[top(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize(("k", "percent"), [(4, 80), (5, 80)])
def test_near(monkeypatch, docs, given, k, percent):
    monkeypatch.setattr(near, "SMALL", 3)  # so that large leaves are tried as well
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near.join(docs, k, percent).collect())
    assert found == brute_near(given, k, percent)


def test_near_keeps_one(docs, empty, given):
    parts = {c for _, n, c in brute_near(given, 5, 80)}
    kept = near.keep(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == parts
    assert near.join(empty).count() == 0


def test_near_recall_at_depth(monkeypatch, spark, docs):
    """All pairs have to stay together down to the last level, in a large group and hung on one link near the threshold."""
    monkeypatch.setattr(near, "SMALL", 1)
    rng = np.random.default_rng(6)
    fresh = lambda n: [f"x{i}" for i in rng.integers(0, 1 << 40, n)]
    base = fresh(600)
    texts = []
    for _ in range(100):
        copy = list(base)
        copy[int(rng.integers(0, 600))] = fresh(1)[0]
        texts.append(copy)
    for _ in range(150):
        own = fresh(66) + base[66:]  # in the group
        texts += [own, own[:-66] + fresh(66)]  # 531 of 663 shingles shared with the text before
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near.join(given, 4, 80).collect())
    assert found == brute_near(rows, 4, 80)
    assert near.lost(near.TREES, near.DEPTH) <= 1 - near.RECALL < near.lost(near.TREES - 1, near.DEPTH)
    assert near.lost(16, 14) > 0.03  # as it was


# -- the pipeline ------------------------------------------------------------


def test_pipeline(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        from orefold.llm.stored import stored

        after = stored(stage(spark, before, sf_dir), f"test_{name}")
        assert after.columns == docs.columns
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        assert {r.doc_id for r in after.select("doc_id").collect()} <= ids
        if name == "near_copies":
            assert sorted(r.doc_id for r in after.collect()) == sorted({c for *_, c in brute_near([(r.doc_id, r.text) for r in before.collect()], 5, 80)})
        if name == "passages":
            kept, _ = brute_spans([(r.doc_id, r.text) for r in before.collect()])
            assert {(r.doc_id, " ".join(words(r.text))) for r in after.collect()} == {(x[0], " ".join(s)) for x, s in kept.items()}
        before = after
    made = Tokenizer.from_str(VOCABULARY)
    encoded = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    expected = Counter((r.doc_id, np.array(made.encode(r.text, add_special_tokens=False).ids, "<u4").tobytes()) for r in before.collect())
    assert Counter((r.doc_id, bytes(r.ids)) for r in encoded.collect()) == expected
