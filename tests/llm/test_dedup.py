"""Exact, near, line and substring dedup, held against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import WHITE, Union, brute_classes, brute_lines, brute_substrings, digest, later_lines, line_places

from pyspark.sql import functions as F

from larderlens.llm import exact_dedup, groups, line_dedup, minhash_dedup, queries, substring_dedup
from larderlens.llm.common import mixed, new_path

# Exact


def test_exact_dedup_decides_by_length_then_id(spark, odd, none):
    told = exact_dedup.decide(odd).collect()
    assert len(told) == odd.count()
    groups_ = defaultdict(list)
    for r in told:
        groups_[r.text_sha256].append(r)
    for own in groups_.values():
        assert sum(r.kept for r in own) == 1 and {r.group_size for r in own} == {len(own)}
    # Of equal lengths the smallest id stays, and of rows that repeat it one.
    assert {r.keep_id for r in told if r.doc_id in (1, 6)} == {1}
    assert [r.kept for r in told if r.doc_id == 6] == [False, False]
    empty = hashlib.sha256(b"").hexdigest()
    assert {r.keep_id for r in groups_[empty]} == {5} and len(groups_[empty]) == 4
    assert exact_dedup.decide(none).collect() == []


def test_exact_stage_keeps_one_row_each(odd):
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    texts = [(r.text or "").translate(WHITE) for r in kept.collect()]
    want = {(r.text or "").translate(WHITE) for r in odd.collect()}
    assert sorted(texts) == sorted(want)


def test_index_keeps_what_earlier_batches_brought(spark):
    index = exact_dedup.DigestIndex(spark, new_path(spark, "index"), buckets=4)
    one = spark.createDataFrame([(5, "a b"), (6, "c")], "doc_id long, text string")
    two = spark.createDataFrame([(1, "ab  "), (2, "d"), (3, "d")], "doc_id long, text string")
    assert {(r.doc_id, r.kept) for r in index.add(one, "one").collect()} == {(5, True), (6, True)}
    for _ in range(2):  # a batch that is added again gets the same answer
        told = {(r.doc_id, r.keep_id, r.kept) for r in index.add(two, "two").collect()}
        assert told == {(1, 5, False), (2, 2, True), (3, 2, False)}
    assert index.read().count() == 3
    plan = index.read().join(index.read().select("text_sha256").hint("merge"), "text_sha256", "left_anti")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


# Components and groups


def test_components_of_random_graphs(spark):
    draw = random.Random(3)
    for n, m in ((40, 25), (60, 200), (30, 29)):
        edges = [(draw.randrange(n), draw.randrange(n)) for _ in range(m)] if m != 29 else [(i, i + 1) for i in range(29)]
        union = Union()
        for a, b in edges:
            union.join(a, b)
        told = {r.node: r.group for r in groups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        touched = {x for a, b in edges if a != b for x in (a, b)}
        assert told == {x: union.find(x) for x in touched}


def test_components_of_few_edges_take_one_step(spark, monkeypatch):
    names, settle = [], groups.settle
    monkeypatch.setattr(groups, "settle", lambda frame, name: (names.append(name), settle(frame, name))[1])
    edges = [(n, n + 1) for n in range(300)] + [(1000 + n, 1000) for n in range(1, 200)] + [(-5, 7000), (7000, -5), (9, 9)]
    rows = spark.createDataFrame(edges, "a long, b long")
    one = {(r.node, r.group) for r in groups.components(rows).collect()}
    assert names == ["edges", "components"]
    monkeypatch.setattr(groups, "FEW_EDGES", 0)
    assert {(r.node, r.group) for r in groups.components(rows).collect()} == one and len(names) > 6
    assert one == {(n, 0) for n in range(301)} | {(n, 1000) for n in range(1000, 1200)} | {(-5, -5), (7000, -5)}
    assert groups.components(rows.limit(0)).collect() == []


def run_groups(spark, members, near):
    def compare(nodes, own, contents):
        assert contents == [str(n) for n in nodes]
        at = dict(zip(nodes, own, strict=True))
        return [(a, a + 1) for a in nodes if a + 1 in at and at[a] != at[a + 1]]

    contents = members.select("node", F.col("node").cast("string").alias("content"), F.lit(1 << 17).alias("weight")).distinct()
    return {r.node: r.group for r in groups.linked_groups(members, near, contents, compare).collect()}


def test_tasks_find_the_links_of_many_texts():
    draw = random.Random(12)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    texts = []
    for _ in range(120):
        words = list(base)
        for at in draw.sample(range(120), draw.randint(0, 6)):
            words[at] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(words * draw.choice([1, 1, 2])))
    texts += ["", "one two", "one two"]
    union = groups.Joined(list(range(len(texts))))
    for a, b in minhash_dedup.linked_texts(list(range(len(texts))), list(range(len(texts))), texts):
        union.join(a, b)
    want = {k: v for k, v in brute_classes(dict(enumerate(texts))).items() if texts[k]}
    assert {k: union.find(k) for k in want} == want


def test_tasks_find_the_links_of_many_lines():
    draw = random.Random(13)
    lines = ["".join(draw.choice("abc") for _ in range(draw.randint(4, 9))) for _ in range(150)]
    own = groups.Joined(list(range(150)))
    for a, b in line_dedup.linked_lines(list(range(150)), list(range(150)), lines):
        own.join(a, b)
    union = Union()
    for a in range(150):
        for b in range(a):
            if line_dedup.is_near(lines[a], lines[b]):
                union.join(a, b)
    assert [own.find(k) for k in range(150)] == [union.find(k) for k in range(150)]


def test_bucket_members_are_compared_or_connected(spark):
    # On a line, near means a distance of 1; the bucket's groups are its runs. One bucket needs blocks, one none.
    places = [p for start in range(0, 400, 10) for p in range(start, start + 1 + start % 4 + start // 100)]
    members = spark.createDataFrame([(0, p) for p in places] + [(1, 3), (1, 7)], "bucket long, node long")
    told = run_groups(spark, members, lambda pairs: pairs.where("b - a = 1"))
    union = Union()
    for a, b in zip(places[:-1], places[1:], strict=True):
        if b - a == 1:
            union.join(a, b)
    assert told == {p: union.find(p) for p in places if p in union.up}


def test_pivots_of_uneven_parts_meet_the_whole_bucket(spark):
    # Over 1,000 open members in the second round, whose two parts of a bucket are on both sides of the share of a frequent key.
    draw = random.Random(21)
    places = [(n, 20 * n + p) for n in range(500) for p in draw.sample(range(8), 4)]
    members = spark.createDataFrame(places, "bucket long, node long")
    told = run_groups(spark, members, lambda pairs: pairs.where("b - a = 1"))
    union = Union()
    held = {p for _, p in places}
    for p in held & {p - 1 for p in held}:
        union.join(p, p + 1)
    assert told == {p: union.find(p) for p in union.up}


def test_a_group_of_copies_takes_a_comparison_each(spark):
    seen = []

    def near(pairs):
        seen.append(pairs.count())
        return pairs

    members = spark.range(200).selectExpr("0L AS bucket", "id AS node")
    told = run_groups(spark, members, near)
    assert set(told.values()) == {0} and len(told) == 200
    assert seen == [199]


# MinHash


def test_classes_are_those_of_brute_force(spark, sf, rows):
    told = queries.op6_minhash_dedup(spark, sf).collect()
    want = brute_classes(rows)
    assert {r.doc_id: r.class_id for r in told} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in told)


def test_copies_around_a_base_are_one_class(spark):
    draw = random.Random(1)
    base = [f"w{draw.randrange(10**6)}" for _ in range(300)]
    rows = {}
    for n in range(60):
        words = list(base)
        for at in draw.sample(range(300), 5):
            words[at] = f"x{draw.randrange(10**6)}"
        rows[n] = " ".join(words)
    rows[60] = " ".join(base)
    rows |= {100 + n: " ".join(f"z{draw.randrange(10**6)}" for _ in range(80)) for n in range(20)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash_dedup.classes(docs).collect()} == brute_classes(rows)


@pytest.mark.parametrize(("common", "own", "most"), [(300, 40, 1), (60, 10, 4), (1, 1, 3)])
def test_sketches_estimate_weighted_similarity(common, own, most):
    rng = np.random.default_rng(2)
    off = []
    for _ in range(40):
        names = mixed(rng.integers(0, 2**62, common + 2 * own).astype(np.uint64))
        a, b = rng.integers(1, most + 1, common + own) * 0.75, rng.integers(1, most + 1, common + own) * 0.75
        left, right = names[: common + own], np.r_[names[:common], names[common + own :]]
        found = minhash_dedup.sketches(np.r_[left, right], np.r_[a, b], np.repeat([0, 1], common + own), 2)
        both = np.minimum(a[:common], b[:common]).sum()
        off.append((found[0] == found[1]).mean() - both / (a.sum() + b.sum() - both))
    assert abs(np.mean(off)) < 0.03 and np.std(off) < 0.08


def test_near_odd_documents(odd, none):
    told = minhash_dedup.classes(odd).collect()
    assert len(told) == odd.count()
    assert {r.class_id for r in told if r.doc_id in (1, 6)} == {1}
    assert {r.class_id for r in told if r.doc_id in (12, 13)} == {12}
    assert {(r.doc_id, r.class_id) for r in told if r.doc_id in (5, 7, 8)} == {(5, 5), (7, 7), (8, 8)}
    kept = minhash_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in told if r.kept)
    assert minhash_dedup.classes(none).collect() == [] and minhash_dedup.keep_first(none).collect() == []


# Lines


@pytest.fixture(scope="module")
def dropped(spark, sf):
    return {r.doc_id: r.dropped for r in queries.op2_line_dedup(spark, sf).collect()}


def test_dropped_lines_are_those_of_the_rule(dropped, rows):
    def compared(x, y):
        found = line_dedup.Signatures([x.encode(), y.encode()])
        names, ends = found.buckets()
        if not set(names[: ends[1]].tolist()) & set(names[ends[1] :].tolist()):
            return False
        return bin(int(found.sims[0]) ^ int(found.sims[1])).count("1") <= line_dedup.MOST_BITS

    assert dropped == brute_lines(rows, compared)


def test_most_near_lines_of_all_pairs_are_dropped(dropped, rows):
    told, all_pairs = ({(k, n) for k, own in x.items() for n in own} for x in (dropped, brute_lines(rows)))
    copies = {(k, n) for k, own in later_lines(rows, line_places(rows).values()).items() for n in own}
    assert copies <= told <= all_pairs
    assert len(told - copies) >= 0.9 * len(all_pairs - copies) > 30


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    draw = random.Random(4)
    for _ in range(2000):
        a, b = ("".join(draw.choice("abc") for _ in range(draw.randint(0, 12))) for _ in range(2))
        assert line_dedup.edit_distance(a, b) == plain(a, b)
        most = draw.randint(0, 12)
        assert (line_dedup.edit_distance(a, b, most) <= most) == (plain(a, b) <= most)


def test_an_edit_leaves_the_parts_away_from_it():
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(300)]
    line = " ".join(words)
    changed = " ".join(words[:100] + ["another"] + words[100:])
    for few in ([line, changed], ["x", "ab cd", line, changed]):
        found = line_dedup.Signatures([x.encode() for x in few])
        one, other = (found.part_sims[found.part_edges[n] : found.part_edges[n + 1]].tolist() for n in (len(few) - 2, len(few) - 1))
        assert len(set(one) - set(other)) <= 3 and len(one) > 30


def test_simhash_of_long_lines_counts_every_gram():
    lines = [b"ab " * 500 + b"c", b"x", b"abcde"]
    told, _ = line_dedup.simhashes(lines)
    from larderlens.llm.common import window_hashes

    for line, sim in zip(lines, told.tolist(), strict=True):
        grams = window_hashes(mixed(np.frombuffer(line.ljust(5), dtype=np.uint8).astype(np.uint64)), 5).tolist()
        assert sim == sum(1 << bit for bit in range(64) if 2 * sum(g >> bit & 1 for g in grams) > len(grams))


def test_variants_of_a_line_are_one(spark):
    line = "The quick brown fox jumps over the lazy dog, 25 times a day; nobody knows why it does so, and it never tells anyone about it."
    rows = [(1, f"{line}\nother"), (2, f"{line.upper()}\n\nmore text"), (3, line.replace("25", "71").replace(",", " -"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.dropped for r in line_dedup.dropped_lines(docs).collect()} == {1: [], 2: [0], 3: [0]}
    assert {r.doc_id: r.text for r in line_dedup.drop_lines(docs).collect()} == {1: f"{line}\nother", 2: "\nmore text", 3: ""}


def test_a_typo_at_the_start_is_found(spark):
    line = "The quick brown fox jumps over the lazy dog near the old mill, and nobody saw it."
    docs = spark.createDataFrame([(1, line), (2, line.replace("The", "qhe", 1))], "doc_id long, text string")
    assert {r.doc_id: r.dropped for r in line_dedup.dropped_lines(docs).collect()} == {1: [], 2: [0]}


def test_tasks_hand_on_the_pairs_of_a_bucket_that_pass_and_members_of_crowded_ones(monkeypatch):
    draw = random.Random(17)
    sims = [draw.getrandbits(64) - 2**63 for _ in range(90)]
    # Buckets of 3, 40 and 47 unlike lines; in the first two, one has a near SimHash, in the last one all have.
    rows = [(b, sims[n], n, 5) for b, lo, hi in ((1, 0, 3), (2, 3, 43), (3, 43, 90)) for n in range(lo, hi)]
    rows += [(1, sims[0] ^ 0xFFFF, 100, 6), (1, sims[1] ^ 1, 101, 7), (2, sims[9] ^ 7, 102, 4), (3, sims[50], 50, 5)]
    rows += [(4, 1 << n % 16, 200 + n, 5) for n in range(40)]
    draw.shuffle(rows)
    batches = [pa.table(dict(zip(("bucket", "sim", "whole", "band"), map(list, zip(*rows, strict=True)), strict=True))).to_batches()[0]]
    told = [r for batch in line_dedup._candidates(iter(batches)) for r in batch.to_pylist()]
    want = {frozenset((sims[0], sims[0] ^ 0xFFFF)), frozenset((sims[9], sims[9] ^ 7))}
    held = [r for r in told if not r["whole"] >= 200]
    assert {frozenset((r["sim"], r["sim_b"])) for r in held} == want and len(held) == 2
    # All of the last bucket are alike: 780 pairs, more than CROWDED a member.
    assert Counter(r["bucket"] for r in told) == {None: 2, 4: 40}
    monkeypatch.setattr(line_dedup, "CROWD", 30)
    told = [r for batch in line_dedup._candidates(iter(batches)) for r in batch.to_pylist()]
    assert Counter(r["bucket"] for r in told) == {None: 1, 2: 41, 3: 47, 4: 40}


def test_buckets_of_unlike_lines_need_no_pivots(spark, monkeypatch):
    # Every bucket that lines shared was worked through with pivots, and each that stayed open was a task's group with its texts.
    draw = random.Random(18)
    fresh = lambda n: " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))
    shared = fresh(30)
    lines = [f"{fresh(60)} {shared} {fresh(60)}" for _ in range(12)] + [fresh(40)] * 2
    lines.append(lines[3].replace("a", "b", 2))

    def none(*args):
        raise AssertionError("no bucket is crowded")

    monkeypatch.setattr(line_dedup, "linked_groups", none)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert {r.doc_id for r in line_dedup.dropped_lines(docs).collect() if r.n_dropped} == {13, 14}


def test_many_pairs_are_told_as_one_by_one(monkeypatch):
    # Pairs were compared one by one, in about a millisecond each.
    draw = random.Random(19)
    pairs = []
    for letters, longest in (("ab ", 40), ("abcdefgh ", 700), ("".join(map(chr, range(300, 700))), 200), ("xyz\U0001f600", 1500)):
        for _ in range(60):
            line = "".join(draw.choice(letters) for _ in range(draw.randint(1, longest)))
            other = list(line)
            for _ in range(draw.randint(0, len(line) * 9 // 20)):
                at = draw.randrange(len(other) + 1)
                other[at : at + draw.randint(0, 1)] = draw.choice([[], [draw.choice(letters)]])
            pairs.append((line, "".join(other)))
    pairs += [("", "a"), ("a", "a"), ("abcd", "abcde"), ("abcde" * 900, "abcde" * 899 + "x"), ("ab" * 3000, "ba" * 3000)]
    want = [line_dedup.is_near(*pair) for pair in pairs]
    assert line_dedup.near_lines(*zip(*pairs, strict=True)).tolist() == want and 60 < sum(want) < 230
    monkeypatch.setattr(line_dedup, "STEP_CELLS", 100)
    assert line_dedup.near_lines(*zip(*pairs, strict=True)).tolist() == want


@pytest.mark.parametrize(("steps", "share"), [(1, 1.0), (2, 0.9), (7, 0.5)])
def test_pairs_that_are_too_far_apart_are_left_early(monkeypatch, steps, share):
    monkeypatch.setattr(line_dedup, "LEAVE_STEPS", steps)
    monkeypatch.setattr(line_dedup, "LEAVE_SHARE", share)
    seen, least_edits = [], line_dedup._least_edits
    monkeypatch.setattr(line_dedup, "_least_edits", lambda *how: (seen.append(least_edits(*how)), seen[-1])[1])
    draw, pairs = random.Random(steps), []
    for n in range(400):
        line = "".join(draw.choices("abcde ", k=draw.randint(1, 120)))
        other = "".join(c if draw.random() < 0.92 - 0.2 * (n % 3) else draw.choice(["", "x", c + "y"]) for c in line)
        pairs.append((line, other))
    want = [line_dedup.is_near(a, b) for a, b in pairs]
    assert line_dedup.near_lines(*zip(*pairs, strict=True)).tolist() == want and 100 < sum(want) < 350
    assert seen


def test_lines_that_others_have_linked_are_not_compared(monkeypatch):
    counts, near_lines = [], line_dedup.near_lines
    monkeypatch.setattr(line_dedup, "near_lines", lambda a, b: counts.append(len(a)) or near_lines(a, b))
    line = "the quick brown fox jumps over the lazy dog near the old mill and nobody saw it"
    lines = [f"{line} {chr(97 + n // 26)}{chr(97 + n % 26)}" for n in range(150)]
    assert len(line_dedup.linked_lines(list(range(150)), list(range(150)), lines)) == 149 and sum(counts) == 149
    # Lines that share a smaller bucket are compared there.
    known = line_dedup._told_before(["", "5,7", "7", "-3", "5,-3"])
    assert {(i, j) for i, j in zip(*np.nonzero(np.triu(known, 1)), strict=True)} == {(1, 2), (1, 4), (3, 4)}


def test_crowded_buckets_of_a_block_need_no_pivots(spark, monkeypatch):
    draw = random.Random(20)
    fresh = lambda n: " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))
    base = fresh(60)
    lines = [f"{base} {fresh(1)}" for _ in range(45)] + [fresh(60)]

    def none(*args):
        raise AssertionError("no bucket is too large for blocks")

    monkeypatch.setattr(line_dedup, "linked_groups", none)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert {r.doc_id for r in line_dedup.dropped_lines(docs).collect() if r.n_dropped} == set(range(1, 45))


def test_lines_of_odd_documents(odd, none):
    told = line_dedup.dropped_lines(odd).collect()
    assert len(told) == odd.count()
    by_id = {r.doc_id: r for r in told if r.doc_id is not None}
    assert by_id[3].n_lines == 0 and by_id[5].n_lines == 3 and by_id[5].n_dropped == 0
    assert by_id[12].n_dropped >= 393 and by_id[13].n_dropped == 400
    assert sorted(r.n_dropped for r in told if r.doc_id in (1, 6)) == [0, 1, 1]
    left = line_dedup.drop_lines(odd)
    assert left.columns == odd.columns and left.count() == odd.count()
    assert line_dedup.dropped_lines(none).collect() == [] and line_dedup.drop_lines(none).collect() == []


# Substrings


def test_substrings_are_those_of_brute_force(spark, sf, rows):
    told = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op8_substring_dedup(spark, sf).collect()}
    assert told == {k: (n, gone, digest(left)) for k, (n, gone, left) in brute_substrings(rows).items()}


def test_shared_passages_of_all_lengths(spark):
    draw = random.Random(9)
    fresh = lambda n: [f"w{draw.randrange(10**7)}" for _ in range(n)]
    hot = fresh(70)
    rows = {n: " ".join(fresh(draw.randint(0, 40)) + hot[draw.randint(0, 10) :] + fresh(draw.randint(0, 40))) for n in range(40)}
    for n, size in enumerate([49, 50, 51, 60, 255, 256, 257, 305, 306, 700]):
        passage = fresh(size)
        rows[100 + 2 * n] = " ".join(fresh(draw.randint(0, 300)) + passage + fresh(5))
        rows[101 + 2 * n] = " ".join(passage + fresh(draw.randint(0, 300)) + passage)
    rows[200] = " ".join(["same"] * 400)
    rows[201] = " ".join(["same"] * 60)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    told = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(docs).collect()}
    assert told == {k: (n, gone, digest(left)) for k, (n, gone, left) in brute_substrings(rows).items()}


def test_rows_of_one_id_do_not_remove_from_each_other(spark):
    draw = random.Random(10)
    fresh = lambda n: " ".join(f"w{draw.randrange(10**7)}" for _ in range(n))
    passage, other = fresh(80), fresh(80)
    rows = [(1, f"{fresh(9)} {passage}"), (1, f"{passage} {fresh(7)}"), (2, f"{fresh(5)} {passage} {other}")]
    rows += [(None, f"{fresh(6)} {other}"), (None, f"{other} {fresh(8)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = [(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.digests(docs).collect()]
    assert Counter(told) == Counter([(1, 89, 0), (1, 87, 0), (2, 165, 80), (None, 86, 80), (None, 88, 80)])


def test_suffix_automaton_statistics():
    draw = random.Random(8)
    for _ in range(300):
        text, query = ([draw.choice(b"ab") for _ in range(draw.randint(0, 20))] for _ in range(2))
        own = substring_dedup.SuffixAutomaton([bytes([c]) for c in text])
        told = list(own.statistics([bytes([c]) for c in query]))
        for at, size in enumerate(told):
            runs = [n for n in range(at + 2) if bytes(query[at + 1 - n : at + 1]) in bytes(text)]
            assert size == max(runs)


def test_removing_spans_keeps_white_space():
    assert substring_dedup.remove_spans(b" a  b\nc d\n e ", [1], [3]) == (b"a d\n e", 2)
    assert substring_dedup.remove_spans(b"a b", [0, 1], [1, 2]) == (b"", 2)
    assert substring_dedup.remove_spans(b"a b c d", [0, 2], [1, 3]) == (b"b d", 2)


def test_substrings_of_odd_documents(odd, none):
    told = substring_dedup.digests(odd).collect()
    assert len(told) == odd.count()
    by_id = {r.doc_id: r for r in told if r.doc_id is not None}
    assert by_id[3].n_words == 0 and by_id[10].n_removed == 0
    # The same text under a larger id goes; rows that repeat an id keep theirs.
    assert by_id[13].n_removed == by_id[13].n_words and by_id[12].n_removed == 0
    left = substring_dedup.shorten(odd)
    assert left.columns == odd.columns and left.count() == odd.count()
    assert {r.doc_id: (r.text, r.n_chars) for r in left.collect()}[13] == ("", 0)
    assert substring_dedup.digests(none).collect() == [] and substring_dedup.shorten(none).collect() == []


def test_indexes_in_folders_of_one_name_are_apart(spark, documents):
    ones = [exact_dedup.DigestIndex(spark, f"{new_path(spark, team)}/index", buckets=2) for team in ("a-b", "a_b")]
    told = [[r.kept for r in index.add(documents, "0").orderBy("doc_id").collect()] for index in ones]
    assert told[0] == told[1] and any(told[0])
    with pytest.raises(ValueError, match="2 buckets"):
        exact_dedup.DigestIndex(spark, ones[0].path, buckets=4)
    again = exact_dedup.DigestIndex(spark, ones[0].path, buckets=2).add(documents, "1")
    assert not again.where("kept").count()


def test_smallest_and_largest_ids(spark):
    rows = [(-(2**63), "a b"), (2**63 - 1, "ab"), (-(2**63), "a b"), (0, "x"), (-5, "x"), (None, "x")]
    told = exact_dedup.decide(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.keep_id) for r in told} == {(-(2**63), -(2**63)), (2**63 - 1, -(2**63)), (0, -5), (-5, -5), (None, -5)}
    assert sum(r.kept for r in told) == 2
