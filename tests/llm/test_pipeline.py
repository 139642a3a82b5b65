import importlib.util
import pathlib
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lodestrata.llm import entry, secrets, simhash, toxicity


def other(name):
    """A neighbouring test module, for its brute force."""
    spec = importlib.util.spec_from_file_location(name, pathlib.Path(__file__).with_name(f"{name}.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def tables(spark, folder):
    r = random.Random(21)
    syllables = ["an", "the", "er", "on", "ti", "re", "in", "st", "ou", "ea"]
    say = lambda n: " ".join("".join(r.choice(syllables) for _ in range(r.randrange(2, 6))) for _ in range(n))
    docs, labels = [], []
    for i in range(240):
        w = say(80).split()
        if i % 4 == 0:
            for _ in range(6):
                w.insert(r.randrange(80), r.choice(["idiot", "moron", "scum", "stupid"]))
        docs.append((i, " ".join(w), "en", f"src{i % 3}", None))
        labels.append((i, 1, int(i % 4 == 0)))
    passage = say(60)
    docs += [(1001, docs[1][1], "en", "s", 3), (1002, f"{say(60)}\n{passage}", "en", "s", 3), (1003, f"{say(60)}\n{passage}\n{say(9)}", "en", "s", 3), (1004, f"{say(70)} password=hunter2hunter2", "en", "s", 3)]
    docs += [(1005, None, None, None, None), (1006, "", "en", "s", 0), (None, say(70), "en", "s", 1), (1004, docs[-1][1], "en", "s", 3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs, passage


def test_stages_take_effect(spark, tmp_path):
    docs, passage = tables(spark, str(tmp_path))
    out, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = out.columns
        out = stage(spark, out, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = out.collect()
        if name != "best_fit_packing":
            assert out.columns == before
    ids = lambda name: sorted(str(r.doc_id) for r in seen[name])
    clean = sorted(str(d) for d, *_ in docs if d is None or d > 240 or d % 4)
    assert ids("toxicity") == clean and ids("line_dedup") == clean
    lines = {r.doc_id: r for r in seen["line_dedup"]}
    assert lines[1001].text == "" and lines[1001].n_chars == 0 and passage in lines[1002].text and passage not in lines[1003].text and len(lines[1003].text.split("\n")) == 2
    # Empty texts are one group, and so are repeated rows.
    assert ids("simhash_near_dedup") == sorted({d for d in clean if d not in ("1005", "1006")})
    secret = {r.doc_id: r.text for r in seen["secret_scan"]}
    assert secret[1004].endswith("[ASSIGN]") and len(secret) == len(seen["simhash_near_dedup"])
    assert ids("best_fit_packing") == ids("secret_scan") and all(r.length <= 2048 for r in seen["best_fit_packing"])


def test_run_and_queries(spark, tmp_path):
    tables(spark, str(tmp_path))
    got = entry.QUERIES["pipeline"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 150
    assert sorted(k.split("_")[0] for k in entry.QUERIES if k.startswith("op")) == sorted(f"op{i}" for i in range(1, 11))


def test_empty_tables(spark, tmp_path):
    tables(spark, str(tmp_path / "a"))
    for t in ("documents", "labels"):
        spark.read.parquet(f"{tmp_path}/a/{t}.parquet").where("false").write.parquet(f"{tmp_path}/b/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0


def test_every_stage_against_brute_force(spark, tmp_path):
    """Repeated rows, clashing columns and a very long text go through all stages; each stage's rows follow from the rows before it."""
    docs, passage = tables(spark, str(tmp_path / "a"))
    r = random.Random(31)
    base = [f"w{r.randrange(3000)}" for _ in range(300)]
    near = [" ".join(base[:i] + ["other"] + base[i + 1 :]) for i in (10, 150)]
    more = [(3000, " ".join(base), "en", "s", 1), (3001, near[0], "en", "s", 1), (3002, near[1].upper(), "en", "s", 1), (3003, " ".join(f"v{i % 9001}" for i in range(60_000)), "en", "s", 1), (3001, near[0], "en", "s", 1)]
    before = spark.createDataFrame(docs + more, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("k", "__k", "fp", "__key", "n"):
        before = before.selectExpr("*", f"doc_id as `{c}`")
    folder = str(tmp_path / "b")
    spark.read.parquet(f"{tmp_path}/a/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    before.write.parquet(f"{folder}/documents.parquet")
    before = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def ran(name, df):
        stages[name](spark, df, folder).write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        return out, [x.asDict() for x in out.collect()]

    rows = [x.asDict() for x in before.collect()]
    out, got = ran("toxicity", before)
    bad = {(x.doc_id, x.k) for x in toxicity.scored(before, spark.read.parquet(f"{folder}/labels.parquet")).where("predicted = 1").collect()}
    assert sorted(map(str, got)) == sorted(str(x) for x in rows if not any(x["doc_id"] == d for d, _ in bad)) and bad
    rows = got
    out, got = ran("line_dedup", out)
    kept = {k[1:]: v for k, v in other("test_linededup").brute([(x["doc_id"], x["text"]) for x in rows], 50).items()}
    want = [x | {"text": kept.get((x["doc_id"], x["text"]), x["text"])} for x in rows]
    assert sorted(map(str, got)) == sorted(str(x | {"n_chars": None if x["text"] is None else len(x["text"])}) for x in want)
    rows = got
    out, got = ran("simhash_near_dedup", out)
    sets = [set(simhash.shingles(x["text"] or "", 5)) for x in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                part = [part[j] if p == part[i] else p for p in part]
    least = {p: min((rows[i]["doc_id"] is None, rows[i]["doc_id"] or 0) for i in range(len(rows)) if part[i] == p) for p in set(part)}
    assert sorted((x["doc_id"] is None, x["doc_id"] or 0) for x in got) == sorted(least.values()) and all(x in rows for x in got)
    rows = got
    out, got = ran("secret_scan", out)
    hidden = [x | {"text": None if x["text"] is None else secrets.masked(x["text"])} for x in rows]
    assert sorted(map(str, got)) == sorted(str(x | {"n_chars": None if x["text"] is None else len(x["text"])}) for x in hidden)
    rows = got
    out, got = ran("best_fit_packing", out)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for x in rows:
        ids = t.encode(x["text"] or "", add_special_tokens=False).ids + [0]
        want += [(x["doc_id"], i // 2048, i, len(ids[i : i + 2048]), zlib.crc32(np.array(ids[i : i + 2048], "<u4").tobytes())) for i in range(0, len(ids), 2048)]
    assert sorted(map(str, ((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in got))) == sorted(map(str, want))
    ends = {}
    for x in sorted(got, key=lambda x: (x["sequence_id"], x["offset"])):
        assert x["offset"] == ends.get(x["sequence_id"], 0)
        ends[x["sequence_id"]] = x["offset"] + x["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= sum(x[3] for x in want) / 2048 * 1.05 + 2
