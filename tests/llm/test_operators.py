"""The text operators against brute force, round trips, held-out figures and odd tables."""

import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom import storage
from voxloom.llm import bpe, editing, licenses, lines, linking, lm, media, packing, pieces, quality, setjoin, sharding, urls
from voxloom.llm import textkit as K

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()))])


def corpus(seed=3, n=160):
    """Texts with exact and near copies, repeated lines, empties and a very long one."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgé") for _ in range(r.randint(1, 7))) for _ in range(400)]
    out = []
    for i in range(n):
        kind = r.random()
        if out and kind < 0.15:
            out.append(r.choice(out))
        elif out and kind < 0.55:
            w = r.choice(out).split(" ")
            for _ in range(r.randint(1, 1 + len(w) // 25)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            out.append(" ".join(w))
        else:
            out.append("\n".join(" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 30))) for _ in range(r.randint(1, 8))))
    out += ["", " \n\t", "one", "one two three four", "One two\tthree four", "a b c d e", " ".join(r.choice(vocabulary) for _ in range(30000))]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(corpus())]
    rows += [(900, None, None, None, None), (901, None, "en", "src0", 0), rows[0], (None, "a b c d e", "en", "src0", 9)]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))


def components(items, linked):
    up = {d: d for d in items}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {d: top(d) for d in items}


def test_op4_is_the_brute_force_join(spark, docs):
    sets = {r.doc_id: shingles(r.text) for r in docs.collect() if r.doc_id is not None}
    want = components(sets, lambda a, b: bool(sets[a]) and bool(sets[b]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    rows = setjoin.link(docs).collect()
    assert len(rows) == docs.count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == {d: (len(sets[d]), want[d]) for d in sets}
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    kept = {r.doc_id for r in setjoin.keep_one(docs).collect()}
    assert kept == {d for d in sets if want[d] == d} | {None}


def test_op4_large_group_of_near_copies(spark):
    """A group beyond the small size whose members link only through others."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(r.randint(0, 14)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(w), "en", "s", 0))
    sets = {r[0]: shingles(r[1]) for r in rows}
    want = components(sets, lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    got = {r.doc_id: r.component_id for r in setjoin.link(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    assert got == want and len(set(want.values())) > 1


def test_layouts_never_lose_a_pair():
    """Pairs at the threshold share a signature in the smaller one's own band."""
    r, lay = np.random.default_rng(2), setjoin.layouts(80)
    for _ in range(150):
        n = int(r.integers(4, 900))
        x = r.integers(0, 1 << 63, n, dtype=np.uint64)
        gone = int(r.integers(0, n // 9 + 1))
        y = np.concatenate([x[gone:], r.integers(0, 1 << 63, gone, dtype=np.uint64)])
        shared = n - gone
        if 100 * shared < 80 * (2 * n - shared):
            continue
        h, first = np.concatenate([np.sort(x), np.sort(y)]), np.array([0, n, 2 * n])
        sig, rec, rid, _ = lay.sign(h, first, np.array([1, 2], np.uint64))
        owner = rid[rec]
        assert set(sig[owner == 1]) & set(sig[owner == 2]), (n, gone)


def test_sketches_bound_the_difference():
    r = np.random.default_rng(1)
    for n, d in ((5, 1), (300, 40), (3000, 700)):
        x = r.integers(0, 1 << 63, n, dtype=np.uint64)
        y = np.concatenate([x[d:], r.integers(0, 1 << 63, d // 2, dtype=np.uint64)])
        a, b = (np.frombuffer(s, np.uint64)[None] for s in linking.sketches(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)])))
        w = min(a.shape[1], b.shape[1])
        assert np.bitwise_count(linking._fold(a, w) ^ linking._fold(b, w)).sum() <= d + d // 2


def test_op2_ids_are_the_tokenizers_and_places_have_no_gap(spark, docs):
    tool = bpe.encoder(bpe.default_path()).tokenizer
    want = sorted((tool.encode(r.text or "", add_special_tokens=False).ids + [0] for r in docs.collect()), key=str)
    packed = packing.pack(docs, keep_ids=True).cache()
    rows = packed.collect()
    whole = {}
    for r in rows:
        whole.setdefault(r.doc_id, []).append(r)
        assert r.length == len(r.ids) <= 2048 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(whole.pop(0)) == 2  # a row that is there twice is packed twice
    for doc, own in whole.items():
        own.sort(key=lambda r: r.piece)
        ids = [i for r in own for i in r.ids]
        assert ids == tool.encode(texts[doc] or "", add_special_tokens=False).ids + [0]
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own[:-1]])) and all(r.length == 2048 for r in own[1:])
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 2048 and sum(at.values()) == sum(map(len, want))
    assert len(at) <= -(-sum(at.values()) // 2048) + 1
    assert sum(len(r.ids) for r in packing.sequences(packed).collect()) == sum(at.values())


def test_op2_plan_places_every_rank_once():
    r = random.Random(1)
    counts = {n: r.randint(1, 50) for n in r.sample(range(1, 101), 60)}
    used, seen = {}, {n: set() for n in counts}
    for length, rank, n, sequence, offset in packing.plan_best_fit(counts, 100):
        for k in range(n):
            assert rank + k not in seen[length]
            seen[length].add(rank + k)
            used.setdefault(sequence + k, []).append((offset, length))
    assert {n: len(s) for n, s in seen.items()} == counts
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100


def test_pretokens_are_the_tokenizers(spark):
    tool, r = bpe.Encoder(bpe.default_path()), random.Random(9)
    some = ["".join(r.choice("ab'st mdrevl  \n\t\r\xa0\x85é1²9½.,!<|endoftext|>€ñ ʼ٠\x01ć") for _ in range(r.randint(0, 30))) for _ in range(3000)] + ["a<|endoftext|>b"]
    ids, first = tool.encode(K.Texts.of(pa.array(some)))
    for i, t in enumerate(some):
        assert list(ids[first[i] : first[i + 1]]) == tool.tokenizer.encode(t, add_special_tokens=False).ids


def test_op5_base_counts(docs):
    for r in quality.judge(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        w = WORD.findall(r.text or "")
        g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        again = {i + k for i, x in enumerate(g) if g.count(x) > 1 for k in range(3)} if len(w) < 2000 else None
        if again is not None:
            assert r.n_repeat_words == len(again)
        solid = [x for x in (r.text or "").split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines) == (len(w), sum(map(len, w)), len(solid) - len(set(solid)))
        assert r.base_failed == (len(w) < 50 or 100 * r.n_repeat_words > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_op5_rejects_boilerplate_and_keeps_clean(spark):
    r = random.Random(2)
    fresh = lambda k: " ".join(f"w{r.randrange(10**7)}" for _ in range(k))
    menu = "\n".join(f"menu {i} of every page of this site is a line" for i in range(10))
    rows = [(i, menu + "\n" + fresh(8 if i < 30 else 300), "en", "h", 0) for i in range(60)] + [(100 + i, fresh(80), "en", "h", 0) for i in range(20)]
    got = {x.doc_id: x.kept for x in quality.judge(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i] == (i >= 30) for i in got)
    assert {x.doc_id for x in quality.keep(spark.createDataFrame(rows, DOCS)).collect()} == {i for i in got if got[i]}


def test_op5_hands_on_kept_documents_without_boilerplate(spark):
    rows = [(i, "Home | About\n" + " ".join(f"w{i}x{k}" for k in range(60)) + "\n\nlast  words\nhome |  about", "en", "h", 0) for i in range(30)]
    rows += [(99, "Home | About\n" + " ".join(f"z{k}" for k in range(60)), "en", "other", 0)]
    kept = {r.doc_id: r.text for r in quality.keep(spark.createDataFrame([*rows, rows[0]], DOCS)).collect()}
    assert kept[99] == rows[-1][1] and len(kept) == 31
    for i, text, *_ in [(r[0], r[1].replace("last  words", f"last  words {r[0]}")) for r in rows[:30]]:
        assert "about" not in kept[i].lower() and kept[i].split("\n")[0] == text.split("\n")[1]


def norm(line):
    return " ".join(WORD.findall(line.translate(LOWER)))


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_op9_is_the_brute_force_line_dedup(spark, docs):
    """Edit distance alone is the truth: nothing else goes, and nearly all of it does."""
    small = docs.where("doc_id is not null and length(text) < 3000")
    found = {}
    for r in small.select("doc_id", "text").distinct().collect():
        for k, x in enumerate(r.text.split("\n")):
            if norm(x):
                found.setdefault(norm(x), []).append((r.doc_id, k))
    names = sorted(found)
    size = [len(x.split(" ")) for x in names]
    pairs = set()
    for a in range(len(names)):
        for b in range(a):
            most = max(len(names[a]), len(names[b])) // 10
            if min(size[a], size[b]) >= lines.NEAR_WORDS and abs(len(names[a]) - len(names[b])) <= most and len(set(names[a].split(" ")) & set(names[b].split(" "))) * 2 >= size[a] and edit(names[a], names[b]) <= most:
                pairs.add((b, a))
    groups = components(range(len(names)), lambda a, b: (a, b) in pairs)
    keeper = {}
    for i, g in groups.items():
        keeper[g] = min([keeper.get(g, (10**9, 0)), *found[names[i]]])
    want = {o for i, g in groups.items() for o in found[names[i]] if o != keeper[g]}
    rows = lines.mark(small).collect()
    gone = {(r.doc_id, k) for r in rows for k in r.removed}
    assert len(rows) == small.count() and gone <= want and len(gone) >= 0.95 * len(want) > 50
    kept = {r.doc_id: r.text for r in lines.dedup(small).collect()}
    for r in small.collect():
        left = [x for k, x in enumerate(r.text.split("\n")) if (r.doc_id, k) not in gone]
        assert kept.get(r.doc_id, "\n".join(left)) == "\n".join(left)


def test_op9_blocks_reach_planted_edits():
    """One replaced word, a tenth of the letters at most, in lines of 8 to 60 words: by SimHash blocks alone."""
    r, alone, n = random.Random(12), 0, 0
    word = lambda: "".join(r.choice("abcdefghijklm") for _ in range(max(1, int(r.gauss(6, 3)))))
    frequent = [word() for _ in range(30)]
    while n < 400:
        x = [r.choice(frequent) if r.random() < 0.4 else word() for _ in range(r.randint(8, 60))]
        y = list(x)
        y[r.randrange(len(y))] = word()
        if edit(" ".join(x), " ".join(y)) > max(len(" ".join(x)), len(" ".join(y))) // 10 or x == y:
            continue
        n += 1
        got = []
        for line in (x, y):
            w = K.words(K.Texts.of(pa.array([" ".join(line)])), True)
            first, letters = np.array([0, len(w.hash)]), w.end - w.start
            got.append(set(lines.block_signatures(w.hash, letters, first).ravel()))
        alone += bool(got[0] & got[1])
    assert alone >= 0.95 * n, alone


def test_op9_removes_repeats_of_short_lines(spark):
    rows = [(1, "Home\n\nfresh words one\nHOME", "en", "s", 0), (2, "read  more\n\nhome\nother", "en", "s", 0), (3, "Read more", "en", "s", 0)]
    found = spark.createDataFrame(rows, DOCS)
    assert {r.doc_id: list(r.removed) for r in lines.mark(found, shortest=1).collect()} == {1: [3], 2: [2], 3: [0]}
    assert {r.doc_id: r.text for r in lines.dedup(found, shortest=1).collect()} == {1: "Home\n\nfresh words one", 2: "read  more\n\nother"}


def test_op9_finds_near_lines_by_edit_distance_alone(spark):
    """Pairs within a tenth of edits that differ in at most an eighth of their words (one word under 16, and none of these is missed)."""
    r = random.Random(8)
    word = lambda k=None: "".join(r.choice("abcdefghié") for _ in range(k or r.randint(1, 9)))
    texts = []
    for i in range(150):
        base = [word() for _ in range(4 + i % 80)]
        for _ in range(2):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 8))):
                k = r.randrange(len(w))
                w[k : k + 1] = r.choice(([word(len(w[k]))], [], [w[k], word(2)]))
                if len(w) == len(base) + max(1, len(base) // 8):
                    break
            texts.append(" ".join(w))
        texts.append(" ".join(base))
    names = [norm(t) for t in texts]
    near = lambda a, b: a // 3 == b // 3 and edit(names[a], names[b]) <= max(len(names[a]), len(names[b])) // 10
    want = components(range(len(names)), near)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    gone = {x.doc_id for x in lines.mark(spark.createDataFrame(rows, DOCS).repartition(3), shortest=1).collect() if x.removed}
    missed = {i for i in want if want[i] != i} - gone
    assert gone <= {i for i in want if want[i] != i} and len(want) - len(set(want.values())) > 100
    few = {i for i in missed if min(len(names[3 * (i // 3) + k].split(" ")) for k in range(3)) < lines.SHORT}
    assert not few and len(missed) <= 0.02 * len(want), (len(few), len(missed))


def test_op9_edit_distance():
    r = random.Random(3)
    for _ in range(2000):
        a = "".join(r.choice("abé ") for _ in range(r.randint(0, 70)))
        b = list(a)
        for _ in range(r.randint(0, 8)):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randint(0, 1)] = r.choice(([], ["x"], ["a", "b"]))
        b = "".join(b)
        most = r.randint(0, 9)
        assert lines.within(a, b, most) == (edit(a, b) <= most)


def test_op9_edit_distance_of_many_pairs():
    """near() is within() at a tenth, and grams() rule no such pair out."""
    r, x, y = random.Random(5), [], []
    for i in range(400):
        letters = r.choice(("ab", "abcdefgh ", "aé中 x", "a😀b "))
        a = "".join(r.choice(letters) for _ in range(r.choice((r.randint(0, 30), r.randint(0, 300), 700 + i, 2600 if i % 40 == 0 else 90))))
        b = list(a)
        for _ in range(int(len(a) / 10 * r.choice((0.5, 0.9, 1, 1.05, 1.6))) + r.randint(0, 1)):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randint(0, 1)] = r.choice(([], [r.choice(letters)], list("ab")))
        x.append(a)
        y.append("".join(b))
    want = [lines.within(a, b, max(len(a), len(b)) // 10) for a, b in zip(x, y, strict=True)]
    assert lines.near(x, y).tolist() == want and 50 < sum(want) < 350
    for a, b, p, q, linked in zip(x, y, lines.grams(x), lines.grams(y), want, strict=True):
        u, v = (np.frombuffer(s, np.uint64)[None] for s in (p, q))
        w = min(u.shape[1], v.shape[1])
        assert not linked or np.bitwise_count(linking._fold(u, w) ^ linking._fold(v, w)).sum() <= 6 * (max(len(a), len(b)) // 10)


def test_op9_lines_that_share_a_passage_are_not_all_compared(spark, monkeypatch):
    """Of the pairs of short lines with one passage only near ones reach the edit distance, and each once."""
    r, looked, across = random.Random(9), [], linking.across
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 8)))
    rows = [(i, " ".join([*(word() for _ in range(5)), "passage", "common", *(word() for _ in range(5))]), "en", "s", 0) for i in range(300)]
    rows += [(300 + i, rows[i][1] + "s", "en", "s", 0) for i in range(0, 300, 10)]

    def seen(*args):
        out = across(*args)
        looked.append(out.count())
        return out

    monkeypatch.setattr(linking, "across", seen)
    gone = {x.doc_id for x in lines.mark(spark.createDataFrame(rows, DOCS)).collect() if x.removed}
    assert gone == set(range(300, 600, 10)) and sum(looked) < 1000, looked


def test_op9_long_lines_that_share_a_passage_give_links_alone(spark, monkeypatch):
    """Lines alike in two thirds of their letters pass the bitmaps and SimHash bits; what leaves a group are the links that join it, not its pairs."""
    r, looked, across = random.Random(10), [], linking.across
    word = lambda: "".join(r.choice("etaoinshr") for _ in range(r.randint(2, 8)))
    passage = " ".join(["passagepassage", "commoncommon", *(word() for _ in range(58))])
    texts = [" ".join([*(word() for _ in range(16)), passage]) for _ in range(160)]
    near = {160 + i: f"{texts[i][2:]} {word()}" for i in range(0, 160, 8)}
    rows = [(i, t, "en", "s", 0) for i, t in [*enumerate(texts), *near.items()]]

    def seen(*args):
        out = across(*args)
        looked.append(out.count())
        return out

    monkeypatch.setattr(linking, "across", seen)
    gone = {x.doc_id for x in lines.mark(spark.createDataFrame(rows, DOCS)).collect() if x.removed}
    assert gone == set(near) and sum(looked) < len(rows), looked


def test_op9_edit_distances_in_batches():
    """Long and short texts, passages, texts beyond Latin-1: as one by one."""
    r, x, y = random.Random(6), [], []
    for i in range(1500):
        letters = r.choice(("ab", "thesoniaé ", "aé中 丮x"))
        text = lambda k: "".join(r.choice(letters) for _ in range(k))
        a, passage = text(r.choice((0, 1, 40, 64, 65, 128, r.randint(1, 260)))), text(r.choice((0, 300)))
        b = list(a)
        for _ in range(r.randint(0, 2 + (len(a) + len(passage)) // 8)):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randint(0, 1)] = r.choice(([], [r.choice(letters)], list("ab")))
        x.append(a + passage)
        y.append((text(len(a)) if i % 5 == 0 else "".join(b)) + passage)
    most = np.array([max(len(a), len(b)) // 10 for a, b in zip(x, y, strict=True)])
    want = [lines.within(a, b, int(k)) for a, b, k in zip(x, y, most, strict=True)]
    alone = []
    got = editing.at_most(x, y, most, lambda k: alone.append(k) or lines.within(x[k], y[k], int(most[k])))
    assert got.tolist() == want and 300 < sum(want) < 1200 and len(alone) < 900


def test_op9_groups_are_compared_together(spark, tmp_path):
    """The contents of many small groups go to one call, and bounds of edits hold as one by one."""
    rows = [(g * 100 + k, 12, lines.grams([f"text {g} {k} of"])[0], f"text {g} {k} of") for g in range(40) for k in range(8)]
    classes = spark.createDataFrame(rows, "rid long, n long, sketch binary, content string")
    members = classes.selectExpr("rid div 100 as sig", "rid", "8L as n", "0 as spare")
    calls = str(tmp_path / "calls")

    def settle(x, y):
        with open(calls, "a") as f:
            f.write(f"{len(x)}\n")
        return np.array([p[-4] == "7" and q[-4] == "0" for p, q in zip(x, y, strict=True)], bool)

    found = linking.across(members, spark.createDataFrame([], "id long, component long"), classes, lambda x, y: x + y, False, settle=settle).collect()
    assert {(r.a, r.b) for r in found} <= {(g * 100, g * 100 + 7) for g in range(40)} and len(found) == 40
    with open(calls) as f:
        assert len(f.readlines()) < 40


def test_lines_are_split_once_for_all_that_go(spark):
    text = "\n".join(f"line {i}" for i in range(3000))
    out = spark.createDataFrame([(text, [0, 5]), ("a\n\nb", [1]), ("a", []), (None, [0])], "t string, p array<int>").select(quality.without_lines(F.col("t"), F.col("p")).alias("t"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert [r.t for r in out.collect()] == ["\n".join(f"line {i}" for i in range(3000) if i not in (0, 5)), "a\nb", "a", None]


def test_op9_signatures_are_dropped_when_lines_have_met(spark):
    folder = Path(storage.shared_dir(spark).removeprefix("file://"))
    before = set(folder.glob("occurrences-*"))
    rows = [(i, f"one two three four five six seven eight nine ten number{i % 3} and{i}\nshort", "en", "s", 0) for i in range(30)]
    assert sum(len(r.removed) for r in lines.mark(spark.createDataFrame(rows, DOCS)).collect()) > 30
    (new,) = set(folder.glob("occurrences-*")) - before
    assert [x.name for x in new.glob("kind=*")] == ["kind=line"]


def test_op8_shards_are_whole_and_even(spark, docs):
    rows = sharding.shard(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    even = spark.createDataFrame([(i, "x" * (i % 90), "en", "s", 0) for i in range(4000)] + [(9000 + i, "hot text", "en", "s", 0) for i in range(2000)], DOCS)
    total = {}
    for r in sharding.shard(even).collect():
        total[r.shard] = total.get(r.shard, 0) + r.size
    assert len(total) == 16 and max(total.values()) - min(total.values()) <= 200


def test_op7_round_trip(docs):
    import hashlib

    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    for r in media.describe(media.store(docs)).collect():
        t = texts[r.doc_id]
        payload = t + b"\xff" * (-len(t) % 576 if t else 576)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(t), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-32:]) and r.feature


def test_op7_reads_other_jpegs():
    """Two components, 2 by 1 sampling, AC terms, no restart markers."""
    dc = media.codes(media.DC_COUNTS, media.DC_VALUES)
    ac_counts, ac_values = (0, 2, 1) + (0,) * 13, (0x00, 0x01, 0xF0)
    ac = media.codes(ac_counts, ac_values)
    levels, other = [5, -3, 100, 7], [9, -9]
    bits, pred = "", [0, 0]

    def block(level, k, terms):
        nonlocal bits
        d, pred[k] = level - pred[k], level
        n = abs(d).bit_length()
        code, size = dc[n]
        bits += f"{code:0{size}b}" + (f"{d if d > 0 else d + (1 << n) - 1:0{n}b}" if n else "")
        for t in terms:
            code, size = ac[t]
            bits += f"{code:0{size}b}" + ("1" if t & 15 else "")
        code, size = ac[0]
        bits += f"{code:0{size}b}"

    for m in range(2):
        block(levels[2 * m], 0, [0x01, 0xF0, 0x01])
        block(levels[2 * m + 1], 0, [])
        block(other[m], 1, [0x01])
    bits += "1" * (-len(bits) % 8)
    scan = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    mark = media._marker
    raw = b"\xff\xd8" + mark(0xDB, b"\0" + bytes([8] * 64)) + mark(0xC0, bytes([8, 0, 8, 0, 32, 2, 1, 0x21, 0, 2, 0x11, 0])) + mark(0xC4, b"\x00" + bytes(media.DC_COUNTS) + bytes(media.DC_VALUES)) + mark(0xC4, b"\x10" + bytes(ac_counts) + bytes(ac_values)) + mark(0xDA, b"\x02\x01\x00\x02\x00\x00\x3f\x00") + scan + b"\xff\xd9"
    (thumb,) = media.thumbnails(media.parse(raw))
    assert thumb.tolist() == [[128 + x for x in levels]]
    with pytest.raises(media.BadImage):
        media.parse(b"no image")


def test_op6_is_the_brute_force_viterbi(spark):
    tool, r = pieces.model(bpe.default_path("piece_bpe_32k.model")), random.Random(0)
    known = {p: (s, i) for i, (p, s, k) in enumerate(tool.pieces) if k in (1, 4)}

    def viterbi(w):
        best = [(0, [])]
        for j in range(1, len(w) + 1):
            top = None
            for i in range(max(0, j - tool.longest), j):
                s, ids = (known[w[i:j]][0], [known[w[i:j]][1]]) if w[i:j] in known else (tool.unk, [int(tool.byte_ids[b]) for b in w[i:j].encode()]) if j - i == 1 else (None, None)
                if s is not None and (top is None or best[i][0] + s > top[0]):
                    top = (best[i][0] + s, best[i][1] + ids)
            best.append(top)
        return best[-1][1]

    some = ["".join(r.choice("abcde thion  é漢\n\t.2▁") for _ in range(r.randint(0, 25))) for _ in range(300)] + ["", " ", "  a", "a  "]
    ids, first = tool.encode(K.Texts.of(pa.array(some)))
    back = tool.decode(ids, first)
    for i, t in enumerate(some):
        assert list(ids[first[i] : first[i + 1]]) == (viterbi("▁" + t.replace(" ", "▁")) if t else [])
        assert back.text(i).decode() == t.replace("▁", " ")
    rows = [(1, "hello there", "en", "s", 0), (2, None, "en", "s", 0)]
    coded = pieces.encode(spark.createDataFrame(rows, DOCS))
    assert {x.doc_id: x.text for x in pieces.decode(coded).collect()} == {1: "hello there", 2: ""} and all(x.round_trip for x in coded.collect())


def test_op6_gives_the_ids_of_sentencepiece(spark):
    import sentencepiece

    path, r = bpe.default_path("piece_bpe_32k.model"), random.Random(1)
    tool = sentencepiece.SentencePieceProcessor(model_file=path)
    some = ["the international community", "", " ", "  a", "a  ", "aaaaaaaaaaaa", "é漢\n\t.2 don't", "x" * 3000]
    some += ["".join(r.choice("abcde thion  é漢\n\t.2") for _ in range(r.randint(0, 60))) for _ in range(300)]
    some += [x.text for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if x.text]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(some)]
    got = {x.doc_id: (x.n_tokens, x.ids_crc32, list(x.ids)) for x in pieces.encode(spark.createDataFrame(rows, DOCS)).collect()}
    for i, t in enumerate(some):
        ids = tool.encode(t)
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids), t[:80]


def test_op1_finds_planted_licenses(spark):
    import textwrap

    mit = max((t for n, t in licenses.SHORT if n == "MIT"), key=len)
    apache = max((t for n, t in licenses.SHORT if n == "Apache-2.0"), key=len)
    prose = "\n".join(f"line {i} of plain prose that holds nothing else at all" for i in range(40))
    full = dict(licenses.TEMPLATES)
    rows = [
        (1, "some prose\nReleased under the MIT license!\nmore"), (2, "plain prose of nothing"), (3, apache.replace("express", "expressed")), (4, None), (5, ""),
        (6, prose + "\n\n" + textwrap.fill(mit, 60) + "\n\n" + prose), (7, "# " + textwrap.fill(apache, 50).replace("\n", "\n# ") + "\ncode\n" * 30), (8, full["GPL-3.0"]),
        (9, (prose + "\n") * 100 + full["MPL-2.0"] + prose), (10, mit), (11, "Released under the MIT License.\nReleased under the MIT License."), (12, "\n".join(["Released under the MIT License."] * 3000)),
    ]
    got = {r.doc_id: (r.license, r.line, r.n_lines) for r in licenses.scan(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)).collect()}
    assert {i: got[i] for i in (1, 2, 3, 4, 5, 10, 11, 12)} == {1: ("MIT", 1, 1), 2: (None, -1, 0), 3: ("Apache-2.0", 0, 1), 4: (None, -1, 0), 5: (None, -1, 0), 10: ("MIT", 0, 1), 11: ("MIT", 0, 1), 12: ("MIT", 0, 1)}
    assert got[6] == ("MIT", 41, len(textwrap.wrap(mit, 60))) and got[7][:2] == ("Apache-2.0", 0) and got[8][0] == "GPL-3.0" and got[9][0] == "MPL-2.0" and got[9][1] >= 4000


PAGES = "page_id long, url string, html string, host int"


def test_op3_rules_and_parts(spark):
    rows = [(1, "http://A.example.ORG/es/1?q", "<p>cheap pills</p>", 1), (2, "https://x.org", None, 1), (3, "https://x.org/", "", 1), (4, None, "", 1), (5, "no scheme", "", 1), (6, "http://n.com/de/#x://y", "", 1), (7, "http://example.org/en/12", "", 1), (8, "http://anexample.org/en/12", "", 1), (9, "://h?x/", "", 1)]
    got = {r.page_id: (r.host, r.path, r.rule) for r in urls.judge(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: ("a.example.org", "/es/1", "example.org/es/"), 2: ("x.org", "", None), 3: ("x.org", "/", "org/"), 4: ("", "", None), 5: ("", "", None), 6: ("n.com", "/de/", "com/de/"), 7: ("example.org", "/en/12", "example.org/en/1"), 8: ("anexample.org", "/en/12", "org/"), 9: ("h", "", None)}
    assert urls.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_op3_segments_and_learns():
    words = urls.WordModel({"cheap": 50, "pills": 40, "news": 60, "a": 5, "site": 30})
    assert words.segment("cheappills") == ("cheap", "pills") and words.segment("newssite") == ("news", "site") and words.segment("zq") == ("z", "q")
    train = [(words.tokens("cheappills.com", "/x"), "block")] * 5 + [(words.tokens("newssite.com", "/x"), "allow")] * 5
    bayes = urls.NaiveBayes(train)
    assert bayes.score(words.tokens("pillscheap.net", "/y")) > 0 > bayes.score(words.tokens("sitenews.net", "/y"))


def test_op10_beats_word_counts_on_held_out_text(spark):
    r = random.Random(1)
    chain = {f"w{i}": [f"w{(7 * i + k) % 60}" for k in range(2)] for i in range(60)}

    def text(n):
        w = ["w0"]
        for _ in range(n):
            w.append(r.choice(chain[w[-1]]))
        return " ".join(w)

    some = spark.createDataFrame([(i, text(20000), "en", "s", 0) for i in range(4)], DOCS).coalesce(1)
    names = lm.count_words(some)
    context, target, *_ = lm.examples(K.Texts.of(pa.array([text(4000)])), names)
    counts = np.log(names.total[target] / names.total.sum()).mean()
    assert abs(lm.Network.fresh(names.total).log_probability(context, target).mean() - counts) < 0.5
    assert lm.train(some, names).log_probability(context, target).mean() > counts + 0.5


def test_op10_beats_word_counts_on_held_out_documents_in_any_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    names = lm.count_words(docs)
    held, known = docs.where("doc_id % 5 = 0"), docs.where("doc_id % 5 != 0")
    context, target, *_ = lm.examples(K.Texts.of(pa.array([x.text for x in held.collect()])), names)
    mean = lambda net: np.concatenate([net.log_probability(context[i : i + 9999], target[i : i + 9999]) for i in range(0, len(target), 9999)]).mean()
    counts, got = mean(lm.Network.fresh(names.total)), [mean(lm.train(known.repartition(n), names, rounds=2)) for n in (1, 6)]
    assert min(got) > counts + 0.1 and abs(got[0] - got[1]) < 0.15, (counts, got)


@pytest.mark.parametrize("known, crowd", [(lm.KNOWN, lm.CROWD), (300, 2)])
def test_op10_is_the_brute_force_sum(spark, docs, known, crowd):
    """Words beyond the known ones and crowded contexts take other ways to the same score."""
    names = lm.count_words(docs, known=known, heads=100, least=2)
    net = lm.train(docs, names, rounds=1)
    got = [(x.doc_id, x.n_tokens, x.log_prob) for x in lm.score(docs, names, net, crowd_of=crowd).collect()]
    rows = [(x.doc_id, WORD.findall((x.text or "").translate(LOWER)), x.text) for x in docs.collect()]
    count, total, pair, context = {}, {}, {}, {}
    seen = []
    for doc, words, text in rows:
        rows_, target, *_ = lm.examples(K.Texts.of(pa.array([text], pa.string())), names)
        p, rare = net.log_probabilities(rows_, target) if words else ([], [])
        seen.append((doc, words, target, p, rare))
        for i, w in enumerate(words):
            count[w], total[target[i]] = count.get(w, 0) + 1, total.get(target[i], 0) + 1
            if target[i] >= lm.HEADS:
                c = (words[i - 1] if i else None, words[i + 1] if i + 1 < len(words) else None)
                context[c], pair[c, w] = context.get(c, 0) + 1, pair.get((c, w), 0) + 1
    want = []
    for doc, words, target, p, rare in seen:
        s = 0.0
        for i, w in enumerate(words):
            if target[i] < lm.HEADS:
                s += p[i]
                continue
            c = (words[i - 1] if i else None, words[i + 1] if i + 1 < len(words) else None)
            prior = np.exp(p[i] - rare[i]) * count[w] / total[target[i]]
            s += rare[i] + np.log((pair[c, w] - 1 + lm.PRIOR * prior) / (context[c] - 1 + lm.PRIOR))
        want.append((doc, len(words), s))
    key = lambda x: (str(x[0]), x[1], x[2])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) <= 1e-3 * max(1, a[1])


def test_op10_scores_repeated_documents_apart(spark):
    r = random.Random(6)
    word = [f"w{r.randrange(30000)}" if r.random() < 0.5 else f"f{r.randrange(30)}" for _ in range(40000)]
    texts = [" ".join(word[i : i + 100]) for i in range(0, 40000, 100)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([*texts, *texts[:40]])] + [(None, None, "en", "s", 0)]
    got = {x.doc_id: x.mean_log_prob for x in lm.fit_and_score(spark.createDataFrame(rows, DOCS)).collect()}
    once, twice = [got[i] for i in range(40, 400)], [got[i] for i in (*range(40), *range(400, 440))]
    assert got[None] is None and np.quantile(twice, 0.1) > np.quantile(once, 0.9)


def test_op10_probabilities_sum_to_one():
    net = lm.Network.of(lm.Network.fresh().flat() * 3)
    sides = np.repeat(np.arange(2 * lm.WINDOW)[None] * (lm.CLASSES + 1), lm.CLASSES, axis=0)
    p, rare = net.log_probabilities(sides, np.arange(lm.CLASSES))
    assert abs(np.exp(p).sum() - 1) < 1e-4 and abs(np.exp(p[lm.HEADS :]).sum() - np.exp(rare[0])) < 1e-4


@pytest.mark.parametrize("run", [setjoin.link, setjoin.keep_one, packing.pack, quality.judge, quality.keep, lines.mark, lines.dedup, sharding.shard, licenses.scan, pieces.encode, lm.fit_and_score, lambda d: media.describe(media.store(d))])
def test_empty_tables_give_empty_results(empty, run):
    assert run(empty).count() == 0


@pytest.mark.parametrize("run", [setjoin.link, packing.pack, quality.judge, lines.mark, sharding.shard, licenses.scan, pieces.encode, lm.fit_and_score])
def test_clashing_columns_nulls_and_repeats(spark, run):
    names = "doc_id long, text string, source string, rid long, size long, removed string, key string, bucket int, lost int, host string, n long"
    rows = [(1, "a b c d e f g h i j", "s", *[None] * 8), (1, "a b c d e f g h i j", "s", *[None] * 8), (None, None, None, *[None] * 8), (2, "", "s", *[None] * 8)]
    assert run(spark.createDataFrame(rows, names)).count() == 4


def thue_morse(n):
    a = "a"
    while len(a) < n:
        a += "".join("b" if c == "a" else "a" for c in a)
    return a[:n], "".join("b" if c == "a" else "a" for c in a[:n])


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_collide_under_polynomial_hashes(spark, n):
    """The pair that has equal hashes modulo 2^64 to any base: as words, as lines and as lines of words."""
    a, b = thue_morse(n)
    words = K.words(K.Texts.of(pa.array([f"{a} {b}"])), True).hash
    assert words[0] != words[1]
    own = K.Texts.of(pa.array([f"{a}\n{b}", " ".join(a) + "\n" + " ".join(b)]))
    assert quality.base_counts(own)[3].tolist() == [0, 0] and len(set(quality.line_keys(own)[3].tolist())) == 4
    rows = [(1, a, "en", "s", 0), (2, b, "en", "s", 0), (3, " ".join(a), "en", "s", 0), (4, " ".join(b), "en", "s", 0)]
    some = spark.createDataFrame(rows, DOCS).coalesce(1)
    tool = bpe.encoder(bpe.default_path()).tokenizer
    got = {}
    for r in packing.pack(some, keep_ids=True).collect():
        got.setdefault(r.doc_id, []).append((r.piece, r.ids))
    assert all([i for _, ids in sorted(got[r[0]]) for i in ids] == tool.encode(r[1], add_special_tokens=False).ids + [0] for r in rows)
    assert {r.doc_id: r.component_id for r in setjoin.link(some).collect()}[2] == 2
    assert not any(r.removed for r in lines.mark(some.where("doc_id < 3")).collect())  # lines of one word link by equality alone
    import sentencepiece

    other = sentencepiece.SentencePieceProcessor(model_file=bpe.default_path("piece_bpe_32k.model"))
    assert all(list(r.ids) == other.encode(rows[r.doc_id - 1][1]) for r in pieces.encode(some).collect())


def test_caches_compare_bytes(monkeypatch):
    """Even where all hashes are equal, ids are those of the words."""
    tool = bpe.Encoder(bpe.default_path())
    monkeypatch.setattr(K, "span_hash", lambda data, start, end: np.full(len(start), 7, np.uint64))
    some = ["one two three", "three two one", "", "a"]
    ids, first = tool.encode(K.Texts.of(pa.array(some)))
    assert [list(ids[first[i] : first[i + 1]]) for i in range(4)] == [tool.tokenizer.encode(t, add_special_tokens=False).ids for t in some]
    model = pieces.Merges(bpe.default_path("piece_bpe_32k.model"))
    ids, first = model.encode(K.Texts.of(pa.array(some)))
    monkeypatch.undo()
    want, bounds = pieces.Merges(bpe.default_path("piece_bpe_32k.model")).encode(K.Texts.of(pa.array(some)))
    assert ids.tolist() == want.tolist() and first.tolist() == bounds.tolist()


def test_lm_opens_a_bucket_in_parts(spark):
    """Buckets that are opened a few bytes at a time give the scores of whole ones."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(2)
    names = lm.count_words(docs, "text")
    net = lm.train(docs, names, "text")
    whole, some = ({r["doc_id"]: r["log_prob"] for r in lm.score(docs, names, net, crowd_of=20, opened=n).collect()} for n in (1 << 40, 2000))
    assert whole.keys() == some.keys() and all(abs(v - some[k]) <= 1e-6 * max(1, abs(v)) for k, v in whole.items())
    many = pa.table({"kind": [lm.BY_CONTEXT], "part": [0], "blob": [b"x" * 10_000]})
    assert lm._parts(many, 1000) >= 10 and lm._parts(many, lm.OPENED) == 1
