"""Operators 11 to 13 against brute force on small fixtures."""

from __future__ import annotations

import hashlib
import heapq
import random
import uuid
import zlib
from collections import defaultdict

import pytest

from strataflow.llm import exact_dedup, prefix_trie, structure_repair
from strataflow.llm.graph import shared_folder

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, n long, row int, digest string, batch string"
TURNS = "conv_id long, turn long, role string, text string, n int, ids string, plan string, present string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x", "y") for i, t in rows], DOCS)


def dedup_brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOW)].append(i)
    for t, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        stays = [True] + [False] * (ids.count(top) - 1)
        for i in ids:
            yield i, top, len(ids), stays.pop() if i == top else False, sha(t)


ROWS = [(1, "Same Text"), (2, "same text"), (7, "SAME TEXT"), (3, None), (4, ""), (None, ""), (5, "É"), (6, "é"), (5, "É"), (5, "É"), (None, "only"), (None, "only"), (8, "x " * 200_000), (9, "X " * 200_000), (10, " same text"), (-3, "same text")]


def key(r):
    return tuple(map(repr, r))


@pytest.mark.parametrize("cut", [(0, 16), (5, 11), (16, 16)])
def test_exact_dedup(spark, cut):
    a, b = cut
    parts = [("a", ROWS[b:]), ("b", ROWS[:a]), ("c", ROWS[a:b])]
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    got = exact_dedup.exact_dedup(spark, [(n, docs_frame(spark, rows)) for n, rows in parts], path)
    want = sorted(dedup_brute(ROWS), key=key)
    assert sorted(map(tuple, got.collect()), key=key) == want
    # Opened anew with another number of buckets asked for; a batch that is there already changes nothing.
    again = exact_dedup.DigestIndex(spark, path, 9)
    again.add(docs_frame(spark, ROWS), "a")
    assert again.state["buckets"] == 4 and sorted(map(tuple, again.decisions().collect()), key=key) == want
    new = docs_frame(spark, [(50, "SAME text"), (51, "new"), (52, None)])
    assert [tuple(r) for r in again.unseen(new).collect()] == [(51, "new", 1, 2, "x", "y")]


def test_exact_dedup_half_done_batch(spark):
    """What a batch appended before it died does not count; added again, it counts once."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    index = exact_dedup.DigestIndex(spark, path)
    index.add(docs_frame(spark, ROWS[:6]), "a")
    index.add(docs_frame(spark, ROWS[6:]), "b")
    del index.state["batches"]["b"]
    exact_dedup.save_json(spark, index.state, index.meta)
    again = exact_dedup.DigestIndex(spark, path)
    assert sorted(map(tuple, again.decisions().collect()), key=key) == sorted(dedup_brute(ROWS[:6]), key=key)
    again.add(docs_frame(spark, ROWS[6:]), "b")
    assert sorted(map(tuple, again.decisions().collect()), key=key) == sorted(dedup_brute(ROWS), key=key)


def test_exact_dedup_plan_and_empty(spark):
    empty = docs_frame(spark, [])
    assert exact_dedup.exact_dedup(spark, exact_dedup.arrivals(empty)).count() == 0
    assert exact_dedup.exact_dedup(spark, []).count() == 0
    index = exact_dedup.DigestIndex(spark, f"{shared_folder(spark)}/{uuid.uuid4().hex}")
    index.add(docs_frame(spark, ROWS), "a")
    plan = index.unseen(docs_frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def turns_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], TURNS)


def in_order(rows, blank):
    out = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = (blank if v is None else v for v in (r, x))
            out[c].append((t is not None, t or 0, r, sha(x), x, t))
    return {c: sorted(v) for c, v in out.items()}


def rem(c):
    """c % 5 as SQL has it, with the sign of c."""
    return c % 5 if c >= 0 else -(-c % 5)


def trie_brute(rows, rebuild):
    convs = {c: [(x[2], x[4]) for x in v] for c, v in in_order(rows, "").items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
        convs = {c: convs.get(c - rem(c), [])[: h[c]] + v[h[c] :] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in sorted(convs.items()):
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
        ends[tuple(s)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    return sorted(map(repr, ((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], sha(",".join(map(str, ends[p])))) for p, m in members.items())))


def talks(seed, n, deep=40):
    rng = random.Random(seed)
    rows = []
    for c in range(-3, n):
        size = rng.choice([1, 2, 2, 3, 5, deep]) if c % 3 else 4
        kind = rng.choice("abc") if c % 3 else "a"
        for t in range(size):
            role, text = ("user", "assistant")[t % 2], f"{kind}{t // 3}é" if rng.random() < 0.9 else rng.choice(["", None, "z", "long " * 50])
            rows.append((c, rng.choice([t, t, t, None]) if c % 7 == 0 else t, rng.choice([role, role, None]), text))
    rng.shuffle(rows)
    return [*rows, (None, 1, "user", "x"), rows[0], rows[1]]


@pytest.mark.parametrize(("seed", "n", "shard"), [(1, 60, 7), (2, 60, 40), (3, 25, 100_000), (4, 2, 3)])
@pytest.mark.parametrize("rebuild", [True, False])
def test_prefix_trie(spark, monkeypatch, seed, n, shard, rebuild):
    monkeypatch.setattr(prefix_trie, "PART", 2)  # driver side; workers keep theirs
    rows = talks(seed, n)
    seqs = prefix_trie.sequences(turns_frame(spark, rows))
    nodes = prefix_trie.trie_nodes(prefix_trie.rebuilt(seqs) if rebuild else seqs, shard)
    assert sorted(repr(tuple(r)) for r in nodes.collect()) == trie_brute(rows, rebuild)


def test_prefix_trie_copies_over_shards(spark):
    """Copies of one conversation, and its prefixes, fill many shards; end lists are hashed across them."""
    rows = [(c, t, "user", f"t{t}") for c in range(1500) for t in range(3 if c % 4 else 2)]
    nodes = prefix_trie.trie_nodes(prefix_trie.sequences(turns_frame(spark, rows)), 300)
    assert sorted(repr(tuple(r)) for r in nodes.collect()) == trie_brute(rows, False)
    assert prefix_trie.trie_nodes(prefix_trie.sequences(turns_frame(spark, []))).count() == 0


def test_shard_in_one_piece():
    """Without Spark: one shard, sequences of many blocks."""
    import pyarrow as pa

    rng = random.Random(3)
    seqs = [[rng.randrange(2) for _ in range(rng.choice([0, 1, 15, 16, 17, 33, 60]))] for _ in range(80)] + [[0] * 50] * 3
    table = pa.table({"conv_id": list(range(len(seqs))), "ids": pa.array([[{"a": x, "b": 0} for x in s] for s in seqs], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), "sizes": pa.array([[1] * len(s) for s in seqs], pa.list_(pa.int32()))})
    got = pa.Table.from_batches(list(prefix_trie.Shard(table, 0).nodes())).to_pylist()
    got = sorted((r["conv_id"], r["depth"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in got if r["kind"] != prefix_trie.ENDS)
    rows = [(c, t, "u", str(x)) for c, s in enumerate(seqs) for t, x in enumerate(s)]
    empty = [c for c, s in enumerate(seqs) if not s]
    want = [eval(r) for r in trie_brute(rows, False)]  # noqa: S307
    want = sorted((0 if d == 0 else c, d, n + (len(empty) if d == 0 else 0), k, leaves, s) for c, d, _, n, k, leaves, s, _ in want)
    assert got == want


def cheapest_brute(rows):
    """Least (cost, letters) over all edit strings, by Dijkstra with the letters in the key."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, letters, i, q = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in (0, 3):
            return cost, letters
        heapq.heappush(heap, (cost + 2, letters + "I", i, {0: 2, 1: 2, 2: 3, 3: 2}[q]))
        if i < len(rows):
            first, must, cut = rows[i]
            heapq.heappush(heap, (cost + 3, letters + "D", i + 1, q))
            if not must:
                to = 3 if q == 2 else 2
                heapq.heappush(heap, (cost + 2 + cut, letters + "R", i + 1, to))
                if first == ("a" if q == 2 else "u"):
                    heapq.heappush(heap, (cost + cut, letters + "K", i + 1, to))
                if first == "s" and q == 0:
                    heapq.heappush(heap, (cost + cut, letters + "K", i + 1, 1))


def random_rows(rng, n):
    return [(rng.choice("uuuaaasx "), rng.random() < 0.15, int(rng.random() < 0.3)) for _ in range(n)]


def test_search_is_cheapest_and_least():
    rng = random.Random(8)
    for _ in range(600):
        rows = random_rows(rng, rng.randrange(0, 14))
        assert structure_repair.search(rows) == cheapest_brute(rows), rows
    for n in (structure_repair.BLOCK - 1, structure_repair.BLOCK, 3 * structure_repair.BLOCK + 7):
        rows = random_rows(rng, n)
        assert structure_repair.search(rows) == cheapest_brute(rows)


def test_search_deepens():
    """The heuristic alone does not answer: bounds below the cost fail and are passed on."""
    rows, failed = [("a", False, 0)], {}
    least = structure_repair.bounds(rows)
    cost, letters = structure_repair.search(rows)
    assert least[0] < cost == 2 and letters == "IK"
    assert structure_repair.descend(rows, least, failed, cost - 1) is None and failed


def repair_brute(rows, damage):
    kept = []
    ids = {r[0] for r in rows if r[0] is not None}
    for c, t, r, x in rows:
        r, x = (" " if v is None else v for v in (r, x))
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 9
        x = "" if f == 1 else x.translate({ord(k): None for k in ".!?"}) if f == 2 else x
        kept += [(c, t, "user" if f == 4 else r, x)] * (0 if f == 0 else 2 if f == 3 else 1)
    convs = in_order(kept, " ")
    for c in ids:
        own, seen, coded, count = convs.get(c, []), set(), [], {"b": 0, "d": 0, "t": 0}
        for *_, role, _, text, _ in own:
            core = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                count[fault] += 1
            coded.append((role[:1], fault in ("b", "d"), int(fault == "t")))
        turns = [x[5] for x in own if x[5] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))  # noqa: B905
        cost, audit = cheapest_brute(coded)
        out, left = [], iter(own)
        for letter in audit:
            row = None if letter == "I" else next(left)
            due = "user" if not out or out[-1][0][:1] != "u" else "assistant"
            if letter == "K":
                out.append((row[2], row[4]))
            elif letter != "D":
                out.append((due, row[4] if row else ""))
        yield (c, gaps, count["b"], count["d"], count["t"], illegal, cost, audit, sha("\n".join(f"{r}:{x}" for r, x in out))), [(c, i, r, x) for i, (r, x) in enumerate(out)]


def chats(seed, n):
    rng = random.Random(seed)
    rows = [(c, rng.choice([t, t, t, t + 3, None]), rng.choice(["user", "assistant", "user", "system", "tool", "", None]) if rng.random() < 0.3 else ("user", "assistant")[t % 2], rng.choice(["Yes.", "No!", "eh", " \t", "", None, "Why?\n", "a. b", "long " * 300, "é…"])) for c in range(-2, n) for t in range(rng.choice([1, 3, 6, 12]))]
    return [*rows, (None, 0, "user", "x."), *[(999, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(700)]]


@pytest.mark.parametrize("damage", [True, False])
def test_structure_repair(spark, damage):
    rows = chats(5, 40)
    frame = turns_frame(spark, rows)
    told, present = (structure_repair.damaged(frame), "present") if damage else (frame, None)
    want = list(repair_brute(rows, damage))
    assert sorted(map(tuple, structure_repair.repair(told, present).collect())) == sorted(w for w, _ in want)
    turns = structure_repair.repaired_turns(told, present)
    assert sorted(tuple(r)[:4] for r in turns.collect()) == sorted(t for _, ts in want for t in ts)
    assert structure_repair.repair(turns_frame(spark, [])).count() == 0


def test_structure_repair_of_dropped_rows(spark):
    """A conversation of which the damage leaves no row."""
    c = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = structure_repair.repair(structure_repair.damaged(turns_frame(spark, [(c, 0, "user", "x.")])), "present").collect()
    assert [tuple(r) for r in got] == [(c, 0, 0, 0, 0, 0, 0, "", sha(""))]
