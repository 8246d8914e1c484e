"""The stages one after another, on planted rows and on the smallest tables."""

from __future__ import annotations

import random

import corpus_pipeline as P
from pyspark.sql import functions as F

from .conftest import edited, prose
from .test_substring_dedup import Corpus, copies, frequent_line

SF = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "substring_dedup", "decontamination", "mixing"]


def planted(llm, folder):
    rnd = random.Random(1)
    text = {i: prose(rnd, 200, 10**6) for i in range(60)}
    passage, leak = prose(rnd, 80, 10**6), prose(rnd, 30, 10**6)
    text[70] = list(text[5])  # copy
    text[71] = edited(rnd, text[6], 2)  # near copy
    text[8] = text[8][:90] + passage + text[8][90:]
    text[9] = text[9][:20] + passage + text[9][20:]
    text[10] = text[10] + leak[5:25]
    text[11] = ["loop", "of", "words"] * 60
    text[12] = ["short"]
    rows = [(i, " ".join(t), "en", f"src{i % 4}", None) for i, t in text.items()]
    rows += [(90, None, "en", "src1", 0), (91, "", None, None, 0)]
    llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    llm.createDataFrame([(1, " ".join(leak))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return text, passage


def test_planted_cases(llm, tmp_path):
    folder = str(tmp_path)
    text, passage = planted(llm, folder)
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    left = []
    for name, step in P.STAGES:
        docs = step(llm, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = llm.read.parquet(f"{folder}/{name}")
        left.append({r.doc_id: r.text for r in docs.collect()})
        if name != "mixing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    quality, near, substring, clean, mixed = left
    everything = set(text)
    assert set(quality) == everything - {11, 12}
    assert set(near) == set(quality) - {70, 71}
    assert set(substring) == set(near)
    assert substring[8] == near[8] and not set(passage[4:-4]) & set(substring[9].split())
    assert all(substring[i] == near[i] for i in near if i != 9)
    assert set(clean) == set(substring) - {10}
    assert set(mixed) <= set(clean) and len(mixed) > 20
    whole = {r.doc_id: r.epochs for r in P.run(llm, folder).collect()}
    assert set(whole) == set(mixed)


def test_smallest_tables(llm):
    rows = P.run(llm, SF).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)


def test_texts_of_one_id_go_by_their_own_duplicates(documents):
    rnd = random.Random(2)
    first, other, third = (prose(rnd, 200, 10**6) for _ in range(3))
    rows = [(1, first), (7, edited(rnd, first, 2)), (7, other), (8, other), (9, third), (None, first)]
    docs = documents(*[(i, " ".join(t)) for i, t in rows])
    left = P.near_duplicates(docs.sparkSession, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted((i or 0, " ".join(t)) for i, t in (rows[0], rows[2], rows[4], rows[5]))


def test_passages_stage_equals_brute_force(documents):
    corpus = Corpus(17)
    line = frequent_line(corpus.rnd)
    for doc in range(3):
        corpus.add(doc, corpus.passage(line))  # dissimilar leaders
    p, q = corpus.prose(120), corpus.prose(90)
    same = corpus.passage(line)
    corpus.add(20, p + corpus.prose(30) + q, same)
    corpus.add(21, p + q)
    corpus.add(22, same, q + p)
    corpus.add(23, p[:60] + corpus.prose(7) + p[60:])
    corpus.check(documents)
    docs = documents(*[(doc, " ".join(words)) for doc, words in corpus.rows.items()])
    left = {r.doc_id: r.text.split() for r in P.repeated_passages(docs.sparkSession, docs, "").collect()}
    assert left[20] == corpus.rows[20] and not list(copies(left))


def test_columns_of_any_name_go_through(documents, llm):
    rnd = random.Random(12)
    texts = [" ".join(prose(rnd, 120)) + "." for _ in range(6)]
    docs = documents(*enumerate(texts), (6, texts[0]), (7, None), (8, ""), (9, texts[1]), (9, texts[2] + " more words"))
    names = ("n_words", "kept", "base_failed", "gone", "goes", "cls", "component_id", "spans", "items")
    docs = docs.select("*", *[F.col("doc_id").alias(name) for name in names])
    for name, step in P.STAGES[:4]:
        out = step(llm, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(row[c] == row.doc_id for row in rows for c in names), name


def test_texts_are_not_shuffled_to_take_rows_or_passages_out(llm, tmp_path):
    planted(llm, str(tmp_path))
    docs = llm.read.parquet(f"{tmp_path}/documents.parquet")
    for step in (P.near_duplicates, P.repeated_passages):
        plan = step(llm, docs, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
