"""Whitening, spelling variants and the streaming BPE against brute force, SQL and the library."""

import hashlib
import json
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sessionforge.llm import queries, spelling, stream_bpe, whitening

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", "ing", "1", "23", " ", "  ", "\n", "\t", "'", "'s", "'re", "!", "...", "é", "你好", "😀", "　", "\x85", "\x1c", "\xa0", "<|endoftext|>", "<|endof", "|>", "\0", "ʰ", "٣", "՘", "-", "'ll"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def bpe():
    return stream_bpe.model(PATH)


def _fed(bpe, text, steps):
    """The ids of a text that comes in pieces, and the most characters and bytes that were held."""
    run, out, at, held = stream_bpe.Transducer(bpe), [], 0, 0
    while at < len(text):
        step = next(steps)
        out += run.feed(text[at : at + step])
        at += step
        held = max(held, len(run._held), len(run._bytes))
    return out + run.end(), held


def test_lookahead_bounds_what_later_text_changes():
    # ab, then c ab: what follows b decides about c, so one chain of two merges reaches two bytes back.
    assert stream_bpe.lookahead([("a", "b")]) == 1
    assert stream_bpe.lookahead([("a", "b"), ("c", "a")]) == 2
    assert stream_bpe.lookahead([("c", "a"), ("a", "b")]) == 1  # the higher rank comes last: no chain
    for wrong in ([("ab", "c")], [("a", "b"), ("a", "b")]):
        with pytest.raises(ValueError):
            stream_bpe.lookahead(wrong)


def test_prefixes_agree_beyond_the_lookahead(bpe):
    rng = random.Random(4)
    for _ in range(40):
        same = "".join(rng.choice(["re", "in", "at", "ion", "er", "s", "th"]) for _ in range(300)).encode()
        a, b = (bpe.merge(same + "".join(rng.choice("abcdefghinorst") for _ in range(rng.randint(0, 40))).encode()) for _ in range(2))
        at = 0
        for x, y in zip(a, b, strict=False):
            at += bpe.size[x]
            if at > len(same) - bpe.lookahead:
                break
            assert x == y


def test_transducer_equals_the_library_however_text_is_cut(bpe, library):
    rng = random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))
        want = library.encode(text, add_special_tokens=False).ids
        assert _fed(bpe, text, iter(lambda: rng.randint(1, 5), 0))[0] == want == bpe.encode([text])[0].tolist(), text


@pytest.mark.parametrize("text", ["a" * 40_000, " " * 40_000, "x" * 3000 + "\n" * 5000 + "y" + "!" * 9000 + "'s" + "1" * 8000, "你好吗" * 9000, " " * 7000 + "<|endoftext|>" + " " * 7000 + "q", "\n" * 70_000 + " q", "inter" * 9000])
def test_transducer_keeps_constant_memory(bpe, library, text):
    steps = random.Random(2)
    got, held = _fed(bpe, text, iter(lambda: steps.randint(1, 3000), 0))
    assert got == library.encode(text, add_special_tokens=False).ids == bpe.encode([text])[0].tolist()
    assert held < 3000 + bpe.window


def test_decoder_equals_the_library_id_by_id(bpe, library):
    rng = random.Random(3)
    for _ in range(1500):
        ids = [rng.randint(0, 50_260) for _ in range(rng.randint(0, 12))]
        back = stream_bpe.Decoder(bpe)
        assert "".join(back.feed([i]) for i in ids) + back.end() == library.decode(ids, skip_special_tokens=False)


def test_bpe_defined_cases(spark, bpe, library):
    rows = [(1, "twin", "x"), (1, "twin", "x"), (None, "no id", "x"), (2, None, "x"), (3, "", "x"), (4, "w " * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = stream_bpe.encode(docs, PATH)
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.ids) for r in got.collect()), key=str) == want and got.where("n_tokens != size(ids)").count() == 0
    assert sorted(((r.doc_id, r.text) for r in stream_bpe.decode(got, PATH).collect()), key=str) == sorted(((i, t or "") for i, t, _ in rows), key=str)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, -1, 99_999, 64])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in stream_bpe.decode(odd, PATH).collect()} == {1: None, 2: "", 3: "a"}
    assert stream_bpe.encode(docs.limit(0), PATH, digest=True).count() == 0


def test_bpe_refuses_other_files():
    with pytest.raises(ValueError):
        stream_bpe.StreamBpe(public_tokenizers.path("word_bpe_49k.json"))


def test_new_words_are_merged_together(bpe, library):
    rng = random.Random(6)
    own, alone = stream_bpe.StreamBpe(PATH, limit=50), []  # a memo that is full at once
    own.merge = lambda data: alone.append(data) or bpe.merge(data)
    words = ["".join(rng.choice(["re", "in", "ät", "ion", "er", "s", "th", "é", "7", "!"]) for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    texts = [" ".join(words[i : i + 40]) + ",\nEnd." for i in range(0, len(words), 40)]
    assert [x.tolist() for x in own.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert not alone


def test_merges_together_equal_merges_alone(bpe):
    rng = random.Random(7)
    pieces = ["".join(rng.choice(["a", "the", "ing", "aaaa", " ", "é", "你", "1", "\n", "!"]) for _ in range(rng.randint(0, 30))).encode() for _ in range(3000)]
    pieces += [b"", b"\xff\x00", b"a" * stream_bpe.SHORT, b"a" * (stream_bpe.SHORT + 1), b"z" * 63]
    assert bpe.merge_all(pieces) == [bpe.merge(p) for p in pieces] and bpe.merge_all([]) == []


def test_marks_stand_where_the_library_cuts(bpe, library):
    rng = random.Random(8)
    parts = ["a", "Z", "é", "1", ".", ",", "..", "'s", "'", " ", "\n", "\r\n", "\t", "\x1c", "\x85", "<|endoftext|>", "ʰ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    assert [x.tolist() for x in bpe.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_names_that_marks_would_cut_stay_whole(tmp_path):
    file = json.load(open(PATH, encoding="utf-8"))
    file["added_tokens"].append(file["added_tokens"][0] | {"id": 50257, "content": "<end. of it>"})
    path = str(tmp_path / "named.json")
    json.dump(file, open(path, "w", encoding="utf-8"))
    text = "so <end. of it> it goes"
    assert stream_bpe.StreamBpe(path).encode([text])[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_registered_bpe(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op13_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        sums = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *sums)


def _whitened(rows):
    """n, deviations, whitened and explained by the whole matrix at once."""
    width = max(len(v) for _, v in rows)
    x = [[int(np.floor(256 * float(np.float32(c)))) for c in v] + [0] * (width - len(v)) for _, v in rows]
    fit = np.array(sorted(set(map(tuple, x))))
    n, sums = len(fit), fit.sum(axis=0)
    v = (fit - sums / n).T @ (fit - sums / n) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    return n, [sum((n * a - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in x], (np.array(x) - sums / n) @ u / np.sqrt(e), e / np.trace(v)


def _holds(got, rows):
    n, deviations, want, explained = _whitened(rows)
    assert len(got) == 4 * len(rows)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    for k in range(4):
        mine = np.array([by[i, k + 1][0].whitened for i, _ in rows])
        assert np.allclose(mine, want[:, k] * np.sign(mine @ want[:, k]), atol=1e-9)
        assert all(by[i, k + 1][0].deviation == d and by[i, k + 1][0].n == n for (i, _), d in zip(rows, deviations, strict=True))
        assert by[rows[0][0], k + 1][0].explained == pytest.approx(explained[k], rel=1e-9)
    assert all(r.identity_error < 1e-9 for r in got)


@pytest.mark.parametrize("tile, row_block", [(None, 4096), (3, 7), (1, 100)])
def test_whitening_by_tiles_equals_one_matrix(spark, tile, row_block):
    rng = np.random.default_rng(0)
    rows = [(i, [float(c) for c in rng.normal(size=7) * np.arange(1, 8)]) for i in range(90)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, rows[1][1][:5])]
    bad = [(200, None), (201, [1.0, None]), (202, [float("inf")] * 7)]
    made = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + bad], "vec_id long, embedding array<float>, n int, x string")
    _holds(whitening.whiten(made, tile=tile, row_block=row_block).collect(), rows)


def test_whitening_defined_cases(spark):
    kind = "vec_id long, embedding array<double>"
    for none in ([], [(1, None), (2, [float("nan")])], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(none, kind)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [1.0, 2.0])], kind)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 6
    line = whitening.whiten(spark.createDataFrame([(1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [4.0, 4.0])], kind)).where("component = 2").collect()
    assert all(r.whitened is None and r.explained < 1e-12 and r.identity_error < 1e-9 for r in line)
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [0.0])], kind)).collect()
    assert all(r.deviation is None and abs(r.whitened) == pytest.approx(1) for r in huge)


def test_registered_whitening(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    _holds(queries.op11_whitening(spark, sf).collect(), rows)


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(a[:i] == b[:i] and a[i:] == b[i + 1 :] for i in range(len(b)))


def test_wavelet_reports_rectangles():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 17, 64, 65):
        values = rng.permutation(n)
        asks = rng.integers(0, n + 1, (40, 4))
        query, value = spelling.Wavelet(values).report(*asks.T)
        want = [(q, v) for q, (low, high, least, most) in enumerate(asks) for v in values[low:high] if least <= v < most]
        assert sorted(zip(query, value, strict=True)) == sorted(want)


@pytest.mark.parametrize("how", [{}, {"bucket": 7}, {"segments": 1}, {"segments": 3, "bucket": 40}])
def test_near_words_are_those_of_brute_force(spark, how):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(250)} | {"aaaaa" + "".join(rng.choice("ab😀") for _ in range(rng.randint(2, 6))) for _ in range(200)} | {"z" * 5000, "z" * 5001}
    counted = spark.createDataFrame([(w, i + 2) for i, w in enumerate(sorted(words))], "w string, n long")
    got = sorted((r.w, r.near) for r in spelling.near_pairs(counted, **how).collect())
    assert got == sorted((a, b) for a in words for b in words if abs(len(a) - len(b)) < 2 and _near(a, b))


def test_large_keys_are_dealt_to_blocks(spark):
    words = [f"prefix{a}{b}suffix" for a in "abcdefghij" for b in "abcdefghij"]
    counted = spark.createDataFrame([(w, 2) for w in words], "w string, n long")
    dealt = []
    frame = type(counted)
    grouped = frame.groupBy
    try:
        frame.groupBy = lambda self, *c: (dealt.append(grouped(self, *c).count().agg(F.max("count")).first()[0]) if c == ("home", "i", "j") else None) or grouped(self, *c)
        got = spelling.near_pairs(counted, bucket=20).count()
    finally:
        frame.groupBy = grouped
    assert got == 100 * 18 and dealt[0] < 4 * 20


def _brute_groups(rows):
    """The contract read literally, by all pairs of words."""
    counts = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            w = low if h % 31 else low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[w] = counts.get(w, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and _near(w, x)] for w in counts}
    form = {w: min(near[w], key=lambda x: (-counts[x], x)) if near[w] and max(counts[x] for x in near[w]) >= 10 * n else None for w, n in counts.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def test_spelling_groups_and_chains(spark):
    def many(word, n):
        return " ".join([word] * n)

    # abcdefg -> abcdefgh -> abcdefghi is a chain of two steps.
    texts = [many("abcdefg", 2), many("abcdefgh", 25), many("Abcdefghi", 300), many("COLOURS", 40), many("coloürs", 3), many("colurs", 9), many("twinsies", 20), many("twinsiez", 20), many("twinsiex", 2), None, "", "short x×y", many("longest", 1), "q" * 40_000 + " " + "q" * 40_000]
    rows = [*enumerate(texts), (None, many("nothing", 4)), (3, texts[3])]
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, n int, w string")
    got = sorted(tuple(r) for r in spelling.group(docs).select("word", "form", "root", "n", "n_near", "form_n").collect())
    want = _brute_groups(rows)
    assert got == want
    assert any(f is not None and r != f for _, f, r, *_ in got)
    assert spelling.group(docs.limit(0)).count() == 0


def test_registered_spelling_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    columns = "word, form, root, n, n_near, form_n"
    got = sorted(map(tuple, queries.op12_spelling_variants(spark, sf).select(*columns.split(", ")).collect()))
    assert got == sorted(con.execute(f"select {columns} from ({spelling.SQL})").fetchall())
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got == _brute_groups(rows)
