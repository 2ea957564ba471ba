"""Defined cases that all operators share, and the registered queries on a whole small table against brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_llm import brute_fp, brute_top, classes, docs, vec
from tokenizers import Tokenizer

import corpus_pipeline
from sessionforge.llm import ann, bpe, packing, pii, queries, secret_scan, topk, toxicity, urls, wordpiece

LONG = "plain words of a long text " * 40_000


def sql(text, **tables):
    con = duckdb.connect()
    for name, t in tables.items():
        con.register(name, t)
    return con.execute(text).fetchall()


def test_searches_on_ties_repeats_and_uneven_vectors(spark):
    whole = lambda v: [int(np.floor(64 * c)) for c in v]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))  # noqa: E731, the rest counts as zeros
    rows = [(20, [0.5, 2.0]), (1, [3.0]), (2, [3.0, 0.0]), (3, [1.0, 1.0, 1.0]), (40, [-1.0, 0.25, 4.0]), (4, [1.0, 1.0, 1.0]), (60, [2.0]), (5, [0.0, -1.5])]
    table = vec(spark, [*rows, (20, [1.0, 2.0]), (20, [0.5, 2.0]), (7, None), (None, [1.0]), (80, [float("nan"), 1.0])])
    exact = topk.top_k(table, F.col("vec_id") % 20 == 0, row_block=3, query_block=2)
    got = sorted(tuple(r) for r in exact.collect())
    assert got == sorted(brute_top(rows, lambda a, b: dot(whole(a), whole(b))))
    assert got == sorted(sql(topk.SQL, embeddings=table.toPandas().query("vec_id == vec_id and embedding == embedding").astype({"vec_id": "int64"})))
    near = ann.nearest(table, F.col("vec_id") % 20 == 0, row_block=3).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, near)) == sorted(brute_top(rows, dot))  # fewer candidates than 20: all of them
    some = [(i, [1.0, 2.0]) for i in range(45)]
    ties = ann.nearest(vec(spark, some), F.col("vec_id") == 20).select("rank", "vec_id").collect()
    assert len(ties) == 20 and [r.vec_id for r in sorted(ties)] == sorted(r.vec_id for r in ties)


def test_toxic_rows_go_and_all_others_stay(spark):
    rows = [(1, None), (2, ""), (3, "you are an idiot"), (3, "you are an idiot"), (4, "a fine day"), (4, "a fine day"), (-1, "no id"), (-1, "you worthless idiot"), (5, LONG), (6, LONG + "you are an idiot")]
    d, model = docs(spark, rows), ({}, toxicity.DEFAULT)
    w0, w1, w2 = toxicity.DEFAULT
    x = toxicity.features([t or "" for _, t in rows], toxicity.Lexicon(), {})
    p = 1 / (1 + np.exp(-(w0 + x[:, 1] * w2 + x[:, 0] * w1)))
    assert {i for i, s in enumerate(p) if s >= 0.5} == {2, 3, 7, 9}
    key = lambda r: (r[0] if r[0] is not None else -1, r[1])
    kept = toxicity.keep(d, model)
    assert kept.columns == d.columns
    assert sorted(map(str, (key(r) for r in kept.collect()))) == sorted(str(r) for r, s in zip(rows, p, strict=True) if s < 0.5)
    assert toxicity.keep(d.limit(0), model).count() == 0


def test_pseudonyms_of_long_repeated_and_empty_tables(spark):
    card = "4111111111111111"
    d = docs(spark, [(1, card), (2, LONG + card), (2, LONG + card), (-1, f"id of {card}"), (3, LONG), (4, None)])
    got = pii.pseudonymise(d).collect()
    one = next(r.text for r in got if r.doc_id == 1)
    assert one != card and sorted((str(r.doc_id), r.n_found) for r in got) == [("1", 1), ("2", 1), ("2", 1), ("3", 0), ("4", 0), ("None", 1)]
    assert {r.text for r in got if r.doc_id == 2} == {LONG + one} and {r.text for r in got if r.doc_id is None} == {f"id of {one}"}
    assert pii.pseudonymise(d.limit(0)).count() == 0


def test_secrets_of_long_repeated_and_clashing_rows(spark):
    forest = secret_scan.train(secret_scan.labelled_findings(spark))
    s = "password=a59e367ba78ab7f8eb"
    d = docs(spark, [(1, s), (2, f"{LONG} {s}"), (2, f"{LONG} {s}"), (-1, s), (3, LONG)]).withColumn("_judged", F.lit("mine")).withColumn("_JUDGED_", F.lit(1))
    found = [(r.doc_id, r.finding, r.length) for r in secret_scan.scan(d, forest).collect()]
    assert sorted(found, key=str) == sorted([(1, 0, 18), (2, 0, 18), (2, 0, 18), (None, 0, 18)], key=str)
    clean = secret_scan.redact(d, forest)
    assert clean.columns == d.columns
    short = "password=[SECRET]"
    want = [(1, short), (2, f"{LONG} {short}"), (2, f"{LONG} {short}"), (None, short), (3, LONG)]
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(want, key=str)
    assert {r["_judged"] for r in clean.select("_judged").collect()} == {"mine"}


def test_pipeline_on_empty_long_and_clashing_tables(spark, sf):
    long = " ".join(f"word{i}" for i in range(40_000))
    rows = [(1, long), (2, long + " more"), (3, None), (4, ""), (None, "a text without id and with other words"), (5, "you are a worthless idiot and you stupid moron know it"), (6, "the password=a59e367ba78ab7f8eb is here")]
    d = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("root", "score", "_old", "text_key", "stays", "first", "_judged", "ids", "queue", "part"):
        d = d.withColumn(name, F.lit("mine"))
    # A null text is an empty one: rows 3 and 4 are copies, of which the first stays.
    for rows_in, want in ((d, {(1, len(long)), (3, None), (None, 38), (6, 29)}), (d.limit(0), set())):
        now = rows_in
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, sf).persist()
            assert tuple(now.columns) == corpus_pipeline.COLUMNS, name
        assert {(r.doc_id, r.n_chars) for r in now.collect()} == want and now.count() == len(want)
        assert corpus_pipeline.packed(spark, now, sf).select("doc_id").distinct().count() == len(want)


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_registered_searches(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    near = {(r.query_id, r.vec_id) for r in queries.op1_neighbours(spark, sf).collect()}
    want = {(q, v) for q, _, v, _ in brute_top(rows, lambda a, b: float(np.dot(a, b)))}
    assert len(near & want) >= 0.9 * len(want) == 0.9 * len(near)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    assert sorted(map(tuple, queries.op5_top_k(spark, sf).collect())) == sorted(con.execute(queries.oracle_sql()["op5_top_k"]).fetchall())


def test_registered_encodings(spark, sf, texts):
    ranks = {t: r for r, t in enumerate(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {i: np.array(library.encode_ordinary(t), "<u4") for i, t in texts.items()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op6_byte_bpe(spark, sf).collect()}
    assert got == {i: (len(x), hashlib.sha256(x.tobytes()).hexdigest(), hashlib.sha256(texts[i].encode()).hexdigest()) for i, x in ids.items()}
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    left = {i: np.array([*whole.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in texts.items()}
    done, filled = dict.fromkeys(texts, 0), {}
    for r in sorted(queries.op8_packing(spark, sf).collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == done[r.doc_id] and r.doc_tokens == len(left[r.doc_id])
        done[r.doc_id] += r.length
        assert zlib.crc32(left[r.doc_id][r.start : done[r.doc_id]].tobytes()) == r.ids_crc32
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert done == {i: len(x) for i, x in left.items()}
    for pieces in filled.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(pieces), [*sorted(pieces)[1:], (sum(n for _, n in pieces), 0)], strict=True))


def test_registered_classes_and_scores(spark, sf, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, sf).collect()}
    fps = [(i, brute_fp(t)) for i, t in texts.items()]
    least = classes(fps, 3)
    assert got == {i: (f"{f:016x}", least[i]) for i, f in fps}
    scores = {r.doc_id: r for r in queries.op2_toxicity(spark, sf).collect()}
    assert set(scores) == set(texts) and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for i, r in scores.items())
    assert {r.doc_id for r in queries.op4_pseudonyms(spark, sf).collect()} == set(texts)
    assert {r.doc_id for r in queries.op10_secrets(spark, sf).collect()} <= set(texts)


def _weighed(text, lexicon):
    """The weights of a text's clauses, each match looked at by itself in all its words."""
    tokens = toxicity._TOKEN.findall(text.lower())
    symbols = [lexicon.symbol(t) for t in tokens]
    kinds = [lexicon.weights[s - toxicity.FIRST][0] if s >= toxicity.FIRST else toxicity._KINDS[s] for s in symbols]
    quoted, reporting, inside, told = [False] * len(kinds), 0, False, [False] * len(kinds)
    for i in range(len(kinds) - 1, -1, -1):  # quotations that a reporting verb follows
        k = kinds[i]
        if inside:
            quoted[i] = True
            inside = k not in "QB"
            reporting = 0
        elif k == "Q" and any(kinds[j] == "R" and not set(kinds[i + 1 : j]) & set("SCBQ") for j in range(i + 1, min(i + 5, len(kinds)))) and reporting:
            inside = True
        else:
            reporting = 4 if k == "R" else 0 if k in "SCB" else max(reporting - 1, 0)
    verb = quote = False
    for i, k in enumerate(kinds):  # after a reporting verb, and in a quotation that it opens
        told[i] = verb or quote
        if k == "R":
            verb = True
        elif k == "Q":
            verb, quote = (False, True) if verb and not quote else (False, False) if quote else (verb, quote)
        elif k == "B" or k == "S" and not quote:
            verb = quote = False
    bounds = [-1, *[i for i, k in enumerate(kinds) if k in "SCB"], len(kinds)]
    clauses = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        total = 0.0
        for i in range(a + 1, b):
            if kinds[i] in "IK":
                aimed = "Y" in kinds[max(a + 1, i - 4) : i] + kinds[i + 1 : min(b, i + 5)]
                w = (1.5 if aimed else 1.0) if kinds[i] == "I" else (2.0 if aimed else 0.3)
                w *= 0.1 if "N" in kinds[max(a + 1, i - 3) : i] else 1.0
                total += w * (0.2 if told[i] or quoted[i] else 1.0) * lexicon.weights[symbols[i] - toxicity.FIRST][1]
        clauses.append(total)
    return clauses


def test_targets_count_on_either_side():
    weigh = lambda t: toxicity.features([t], toxicity.Lexicon(), {})[0, 0]
    assert weigh("i will kill you") == 2.0 > weigh("such an idiot") == 1.0 > weigh("kill time") == 0.3
    assert weigh("such an idiot you are") == weigh("you are such an idiot") == 1.5
    assert weigh("kill time. you and me") == weigh("kill one two three four you") == 0.3
    assert weigh('"i will kill you", she said') == weigh("she said i will kill you") == pytest.approx(0.4)
    assert weigh("i will not kill you") == pytest.approx(0.2)


def test_registered_toxicity_equals_matches_weighed_one_by_one(spark, sf, texts):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    learned, (w0, w1, w2) = toxicity.learn(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    lexicon = toxicity.Lexicon(learned)
    made = ['he said: "you idiot. you are stupid!" and left. you moron', '"kill you", he wrote, not you, idiot "so stupid" said she "kill"', "no idiot you: kill them\nthey said\nyou loser, kill", 'a "b said "idiot" said you']
    for t in made + list(texts.values()):
        assert max(_weighed(t, lexicon)) == pytest.approx(toxicity.features([t], lexicon, {})[0, 0]), t[:200]
    for r in queries.op2_toxicity(spark, sf).collect():
        clauses = _weighed(texts[r.doc_id], lexicon)
        assert r.heaviest == pytest.approx(max(clauses)) and r.together == pytest.approx(np.log1p(sum(clauses)))
        assert r.score == pytest.approx(1 / (1 + np.exp(-(w0 + w1 * r.heaviest + w2 * r.together))))


def test_forest_without_labelled_secrets_keeps_nothing(spark):
    kind = "before string, candidate string, after string, label int"
    docs = spark.createDataFrame([(1, "password = hunter2hunter2X9")], "doc_id long, text string")
    for findings in ([], [("password = ", f"hunter{i}hunter", "", 0) for i in range(20)]):
        forest = secret_scan.train(spark.createDataFrame(findings, kind))
        assert secret_scan.scan(docs, forest).count() == 0 and secret_scan.redact(docs, forest).first().text == "password = hunter2hunter2X9"


def test_registered_token_counts_are_those_of_greedy_matching(spark, sf, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = {"".join(map(chr, p)) for p in wordpiece.read_pieces(path)}
    longest = max(map(len, pieces))
    library, back, known = Tokenizer.from_file(path), {c: b for b, c in enumerate(wordpiece.byte_letters())}, {}

    def greedy(word):
        """The pieces of a word, longest first; 0 where it can't be finished."""
        if word not in known:
            s, i, n = "".join(chr(back[c]) for c in word) + chr(wordpiece.END), 0, 0
            while i < len(s):
                i = next((j for j in range(min(len(s), i + longest), i, -1) if s[i:j] in pieces), 0)
                n += 1
                if not i:
                    n = 0
                    break
            known[word] = n
        return known[word]

    got = {r.doc_id: (r.n_words, r.n_pieces, r.n_unknown) for r in queries.op7_token_counts(spark, sf).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        each = [greedy(w) for w, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(t))]
        assert got[i] == (len(each), sum(max(n, 1) for n in each), each.count(0)), i


def test_links_in_very_long_pages(spark):
    link = lambda u: f'<link rel="canonical" href="{u}">'
    junk = "<p class='a'>text &amp; more</p>\n" * 60_000
    rows = [(1, "http://a.com/x", junk + link("http://b.net/y") + junk), (2, "http://b.net/y", "<" * 500_000), (3, "http://c.com/", "<link " + "x=1 " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in urls.judge(pages).collect()} == {1: "block", 2: "block", 3: "allow"}


def test_packing_gives_the_ids_themselves(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Good day to you", "", None, "words " * 9000, "twice", "twice"]
    made = spark.createDataFrame([(i, t, "s", "ids") for i, t in enumerate(texts)], "doc_id long, text string, source string, ids string")
    library, left = Tokenizer.from_file(path), {}
    for r in sorted(packing.pack(made, path, with_ids=True).collect(), key=lambda r: (r.doc_id, r.start)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        left.setdefault(r.doc_id, []).extend(ids)
    assert left == {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}


def test_toxicity_learns_from_one_text_and_the_largest_label_of_a_doc_id(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    once = toxicity.learn(docs, labels)
    conflicting = labels.unionByName(labels.where("toxic = 1").withColumn("toxic", F.lit(0))).unionByName(labels.withColumn("toxic", F.lit(None).cast("int")))
    several = docs.unionByName(docs.withColumn("text", F.concat("text", F.lit(" and more")))).unionByName(docs)
    assert toxicity.learn(several, conflicting) == once
    held_out = labels.withColumn("toxic", F.when(F.expr("crc32(cast(doc_id as string)) % 5 = 0"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, held_out) == once
