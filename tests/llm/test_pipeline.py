"""The corpus pipeline stage by stage against plainer versions of the same stages."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from itertools import pairwise

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from strataflow.llm import language_id
from strataflow.llm.queries import tokenizer_path
from tests.llm.test_operators import WORD, groups_brute, sets_brute

SF = "/root/testdata/sf0.001"


def plain_language(text, model):
    """(language, rejected) by n-grams counted one by one."""
    seen = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in text.encode()]
    bag = Counter()
    for size in (1, 2, 3):
        for i in range(len(seen) - size + 1):
            gram = seen[i : i + size]
            if gram == [32] or any(a == b == 32 for a, b in pairwise(gram)):
                continue
            code = 0
            for b in gram:
                code = (code * 256 + b) % (1 << 32)
            bag[(((code * 2654435761) % (1 << 32)) ^ ((size * 0x35EBCA6B) % (1 << 32))) >> 20] += 1
    v = np.zeros(language_id.DIM)
    for slot, n in bag.items():
        v[slot] = math.log1p(n) * model.idf[slot]
    cos = model.centroids @ (v / max(np.linalg.norm(v), 1e-12))
    best = int(cos.argmax())
    return model.langs[best], bool(cos[best] < model.least(np.array([len(seen)]))[0])


def plain_lines(texts):
    """Texts by doc_id without later copies of two lines and of long lines; those that lose all lines are left out."""
    seen, out = set(), {}
    for d in sorted(texts):
        lines = texts[d].split("\n")
        gone = set()
        for i, line in enumerate(lines):
            for key, size in (((tuple(lines[i : i + 2])), 2), ((line,), 1)):
                if size == 2 and i + 1 == len(lines) or size == 1 and len(re.split(r"\s+", line.strip())) < 51:
                    continue
                gone |= set(range(i, i + size)) if key in seen else set()
                seen.add(key)
        kept = [x for i, x in enumerate(lines) if i not in gone]
        if kept:
            out[d] = "\n".join(kept)
    return out


def plain_leak(text, items):
    gram = lambda w: [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    w = WORD.findall(text.lower())
    have = set(gram(w))
    for item in items:
        own = WORD.findall(item.lower())
        mine = Counter(gram(own))
        if not have & mine.keys():
            continue
        for s in range(max(1, len(w) - len(own) + 1)):
            a = Counter(gram(w[s : s + len(own)]))
            if 4 * sum((a & mine).values()) >= 3 * sum((a | mine).values()):
                return True
    return False


def test_stages(spark, tmp_path):
    docs, cols, items = spark.read.parquet(f"{SF}/documents.parquet"), None, [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    junk = spark.createDataFrame([(900_001, "Ñíue " * 800, None, "junk", 4000), (900_002, None, "en", "junk", 0)], docs.schema)
    docs, counts = docs.union(junk), []
    for name, stage in corpus_pipeline.STAGES:
        cols, model = docs.columns, language_id.fit(docs) if name == "language_id" else None
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = docs.collect()
        counts.append((len(before), len(after)))
        if name != "bpe":
            assert docs.columns == cols == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "language_id":
            assert {r.doc_id for r in after} == {d for d, t in before.items() if t and re.search(r"[^\W\d_]", t) and not plain_language(t, model)[1]}
            assert 900_001 in before and not {900_001, 900_002} & {r.doc_id for r in after}
        if name == "line_dedup":
            assert {r.doc_id: r.text for r in after} == plain_lines(before) and all(r.n_chars == len(r.text) for r in after)
        if name == "jaccard_join":
            ids = sorted(before)
            groups = groups_brute(list(sets_brute([before[i] for i in ids])))
            assert {r.doc_id for r in after} == {ids[g] for _, g in groups}
        if name == "decontamination":
            assert {r.doc_id for r in after} == {d for d, t in before.items() if not plain_leak(t, items)}
        if name == "bpe":
            own = Tokenizer.from_file(tokenizer_path())
            for r in after:
                ids = own.encode(before[r.doc_id], add_special_tokens=False).ids
                assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert all(a > b for a, b in counts[:-1]) and counts[-1][0] == counts[-1][1]
    assert corpus_pipeline.run(spark, SF).count() == counts[-1][1]


def test_stages_edges(spark):
    """Every stage on tables without rows, of one row, and with nulls in every column."""
    full = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, None), (2, "a word or two", "en", None, None)], full.schema)
    for docs in (full.limit(0), full.limit(1), odd):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() <= docs.count()


def test_long_single_lines(spark):
    """A repeated line of over 50 words goes between any neighbours, also as a whole document; shorter ones stay."""
    long, short = " ".join(f"w{i}" for i in range(51)), " ".join(f"w{i}" for i in range(50))
    texts = [f"a\n{long}\nb", f"c\n{long}\nd", long, f"e\n{short}\nf", f"g\n{short}\nh", f"b\n{long}\nb\n{long}", f"x\nc\n{long}\ny", ""]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.lines(spark, docs, SF).collect()}
    want = {0: texts[0], 1: "c\nd", 3: texts[3], 4: texts[4], 5: "b", 6: "x\ny", 7: ""}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_lines_keep_rows(spark):
    """Each row gives one row with its own columns: null and repeated doc_ids, nulls elsewhere."""
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, "a\nb\nc", "en", "n1"), (None, "a\nb\nc", "de", "n2"), (1, "a\nb\nc", None, "r1"), (1, "a\nb\nc", "en", "r2"), (2, "a\nb\nz", "en", "s1"), (2, "q\nr\ns", "de", None), (3, None, "en", "gone"), (4, "a\nb", "en", "gone")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) if r[1] else (*r, None) for r in rows], cols)
    got = sorted(map(tuple, corpus_pipeline.lines(spark, docs, SF).collect()), key=str)
    want = [(*r, 5) for r in rows[:4]] + [(2, "z", "en", "s1", 1), (2, "q\nr\ns", "de", None, 5)]
    assert got == sorted(want, key=str)
