import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.llm import chat, line_dedup, neighbours, surrogates

from . import helpers as H


def lines_brute(rows, percent=80, least=1):
    lines = []
    for doc, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        lines += [(doc, i, frozenset(H.words(line))) for i, line in enumerate(text.split("\n"))]
    lines = [x for x in sorted(set(lines), key=lambda x: x[:2]) if len(x[2]) >= least]
    held, out = {}, set()
    for k, (doc, i, s) in enumerate(lines):
        seen = {}
        for w in s:
            for j in held.get(w, ()):
                seen[j] = seen.get(j, 0) + 1
            held.setdefault(w, []).append(k)
        if any(100 * n >= percent * (len(s) + len(lines[j][2]) - n) for j, n in seen.items()):
            out.add((doc, i))
    return out


@pytest.mark.parametrize("odd", [False, True])
def test_line_dedup_matches_brute_force(spark, medium, odd):
    df = H.documents(spark, H.odd_rows()) if odd else spark.read.parquet(f"{medium}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    found = line_dedup.removed_lines(df).collect()
    assert {(r["doc_id"], i) for r in found for i in r["removed"]} == lines_brute(rows)
    assert len(found) == len(rows)
    assert sorted((r["doc_id"] or 0, r["n_lines"]) for r in found) == sorted((d or 0, 0 if t is None else len(t.split("\n"))) for d, t in rows)


def test_line_dedup_apply(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [(1, line + "\nkept here", "en", "a"), (2, "start\n" + line.replace("ten", "eleven") + "\nend", "en", "a"), (3, None, "en", "a")]
    df = H.documents(spark, rows)
    got = {r["doc_id"]: r["text"] for r in line_dedup.apply(df).collect()}
    assert got == {1: line + "\nkept here", 2: "start\nend", 3: None}
    assert line_dedup.apply(df).columns == df.columns
    assert line_dedup.removed_lines(H.documents(spark, [])).collect() == []


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("leaf", F.lit("x")).withColumn("score", F.lit(1))


def test_neighbours_recall_and_scores(spark, medium):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = df.toPandas()
    ids, x = data["vec_id"].to_numpy(), np.stack(data["embedding"].to_list()).astype(float)
    got = neighbours.search(df).toPandas()
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        best = set(ids[np.argsort(-score)[:20]].tolist())
        mine = got[got["query_id"] == ids[i]].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21))
        assert (mine["score"].diff().dropna() <= 0).all()
        at = {v: k for k, v in enumerate(ids)}
        assert np.allclose(mine["score"], [score[at[v]] for v in mine["vec_id"]])
        hits += len(best & set(mine["vec_id"]))
        total += 20
    assert hits / total >= 0.9


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], None), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [None, 1.0], 1), (8, [1.0], 1), (20, [0.5, 0.5], 1), (None, [1.0, 1.0], 1), (40, [], 1)]
    got = [tuple(r) for r in neighbours.search(vectors(spark, rows)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5), (20, 3, 2, 0.5)]
    assert neighbours.search(vectors(spark, [])).collect() == []


def test_chat_prompt_is_the_common_prefix(spark):
    schema = "conv_id long, turn long, role string, text string, pair_id string"
    rows = [(0, 0, "user", "hi", "x"), (0, 1, "assistant", "yes", "x"), (1, 0, "user", "hi", "x"), (1, 1, "assistant", "no", "x"), (1, 2, "user", None, "x"),
            (2, 0, None, "a", "x"), (3, 0, None, "a", "x"), (3, 1, "assistant", "b", "x"), (4, 0, "user", "alone", "x"), (None, 0, "user", "lost", "x")]
    turns = spark.createDataFrame(rows, schema)
    got = {r["pair_id"]: r for r in chat.preference_pairs(turns, chat.neighbours(turns)).collect()}
    assert set(got) == {0, 1}
    assert got[0]["prompt"] == "<|user|>\nhi<|end|>\n" and got[0]["prompt_turns"] == 1
    assert got[0]["chosen"] == "<|assistant|>\nyes<|end|>\n" and got[0]["chosen_mask"] == f"1:{len(got[0]['chosen'])}"
    assert got[0]["rejected_mask"] == "1:24,0:17" and sum(int(x[2:]) for x in got[0]["rejected_mask"].split(",")) == len(got[0]["rejected"])
    assert got[1]["chosen"] == "" and got[1]["chosen_mask"] == "" and got[1]["prompt_turns"] == 1
    empty = turns.where("false")
    assert chat.preference_pairs(empty, chat.neighbours(empty)).collect() == []


def test_surrogates_are_consistent_and_distinct(spark):
    text = "Call +1 (017) 555-7713 or 1-017-555-7713. Mail ann.b@mail7.example.com, Ann.B@mail7.example.com. Host 97.51.17.173. Card 9807915762804490."
    rows = [(1, text, "en", "a"), (2, "again ann.b@mail7.example.com and +1 (017) 555-7713", "en", "a"), (3, 'token = "' + "04dbebab91" * 4 + '"', "en", "a"),
            (4, "Frau Clara Schmidt met Mr. Smith and Señora Vega", "de", None), (5, None, None, None), (6, "1.2.3 and 12345678901234567 are clean", "en", "a")]
    got = {r["doc_id"]: r for r in surrogates.replace(H.documents(spark, rows)).collect()}
    assert got[5]["text"] is None and got[6]["text"] == rows[5][1] and got[6]["n_entities"] == 0
    for real in ("555-7713", "ann.b", "97.51.17.173", "9807915762804490", "04dbebab91", "Schmidt", "Smith", "Vega"):
        assert all(real not in (r["text"] or "") for r in got.values()), real
    mails = re.findall(r"[\w.]+@[\w.]+\w", got[1]["text"])
    assert len(set(mails)) == 1 and mails[0] in got[2]["text"]
    phone = re.search(r"\+\d \(\d{3}\) \d{3}-\d{4}", got[1]["text"])[0]
    assert phone in got[2]["text"]
    assert re.search(r"Frau (Anna|Clara|Elena|Ida|Julia|Laura|Maria|Nora|Olga|Rosa|Sofia|Vera) \w+ met Mr\. \w+ and Señora \w+$", got[4]["text"])
    assert re.search(r"^Call .* or .*\. Mail .*, .*\. Host 10\.\d+\.\d+\.\d+\. Card \d{16}\.$", got[1]["text"])
    assert surrogates.replace(H.documents(spark, [])).collect() == []


def test_surrogates_never_collide(spark):
    rows = [(i, f"host 10.{i % 256}.{i // 256}.7 and 9{i:015d}", "en", "a") for i in range(3000)]
    got = surrogates.replace(H.documents(spark, rows, extra=False)).collect()
    hosts = [re.search(r"10\.\d+\.\d+\.\d+", r["text"])[0] for r in got]
    assert len(set(hosts)) == 3000 and not set(hosts) & {f"10.{i % 256}.{i // 256}.7" for i in range(3000)}
    assert len({re.search(r"\d{16}", r["text"])[0] for r in got}) == 3000


def test_surrogates_over_odd_rows(spark):
    df = H.documents(spark, H.odd_rows())
    before = sorted((r["doc_id"] or 0, r["text"] or "") for r in df.collect())
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in surrogates.replace(df).collect()) == before
