"""Top-k search, url filter, pipeline and registration."""
import math
import random
import re
from collections import Counter

import pytest

from leadlens.llm import topk_search, url_filter
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("scale,block_rows,pivots", [(256, 50, 1024), (10 ** 9, 50, 1024), (256, 1000, 7), (256, 20, 0)])
def test_search_by_hand(spark, scale, block_rows, pivots):
    rng = random.Random(scale)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], 0) for i in range(260)]
    rows += [(300 + i, [0.5] * 6, 0) for i in range(40)]  # ties
    rows += [(400, None, 0), (401, [0.1, None, 0.0, 0.0, 0.0, 0.0], 0), (450, [float("nan")] * 6, 0), (500, [float("inf")] * 6, 0),
             (550, [0.25, 0.5], 0), (551, [0.5, 0.5], 0), (None, [9.0] * 6, 0), (600, [], 0), (650, [], 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("x")).withColumn("rank", F.lit(1)).repartition(4)
    spec = topk_search.TopK(scale=scale, block_rows=block_rows, pivots=pivots, query_rows=3, chunk=8)
    got = topk_search.top_k(df, F.col("vec_id") % 50 == 0, spec).drop("evaluated").collect()
    f32 = {r.vec_id: r.embedding for r in df.collect() if r.vec_id is not None and r.embedding is not None}
    v = {i: [math.floor(scale * x) for x in e] for i, e in f32.items()
         if all(x is not None and math.isfinite(x) for x in e)}
    exp = set()
    for q in (i for i in v if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(v[q], v[o])), o) for o in v if o != q and len(v[o]) == len(v[q]))
        exp |= {(q, k + 1, o, -s) for k, (s, o) in enumerate(scores[:5])}
    assert {tuple(r) for r in got} == exp and len(got) == len(exp)


@pytest.mark.parametrize("block_rows", [1024, 4096])
def test_search_leaves_candidates_out(spark, block_rows):
    """The pivots and the scores that queries bring along spare evaluations, on the given vectors and more so on grouped ones."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").dropna()
    n = rows.count()
    spec = topk_search.TopK(block_rows=block_rows)
    share = lambda df: (topk_search.top_k(df, F.col("vec_id") % 50 == 0, spec).filter("rank = 1")
                        .agg(F.avg("evaluated")).first()[0] / (n - 1))
    given = share(rows)
    near = F.transform("embedding", lambda x, i: F.when(i == F.pmod("vec_id", F.lit(32)), x + 3).otherwise(x / 10))
    grouped = share(rows.select("vec_id", near.alias("embedding")))
    print("evaluated", given, grouped)
    assert given < 0.6 and grouped < 0.2


def test_search_repeats_no_block(spark):
    """Blocks meet without being multiplied first, which would grow with the square of the table; whole blocks evaluated for
    many queries at once give what single ones give."""
    rng = random.Random(3)
    rows = [(i % 390, [rng.uniform(-1, 1) for _ in range(5)], 0) for i in range(400)] + [(900, [0.5] * 5, 0), (901, [0.5] * 5, 0)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    ask = lambda **x: topk_search.top_k(df, F.col("vec_id") % 10 == 0, topk_search.TopK(block_rows=30, query_rows=7, **x))
    found = ask()
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "explode" not in plan
    base = {tuple(r) for r in found.drop("evaluated").collect()}
    assert len(base) == 5 * 41  # rows of one id that differ are queries of their own: id 0
    dense = ask(dense=0.0, asked_rows=10).collect()
    assert {tuple(r)[:4] for r in dense} == base and max(r.evaluated for r in dense) > 372  # all but some of the first block
    assert {tuple(r) for r in ask(dense=2.0).drop("evaluated").collect()} == base


def test_far_apart_pivots():
    import numpy as np
    rows = np.array([[0.0], [1.0], [10.0], [10.0], [4.0]])
    assert topk_search.far_apart(rows, 3).ravel().tolist() == [0.0, 10.0, 4.0]
    assert len(topk_search.far_apart(rows, 9)) == 4 and len(topk_search.far_apart(rows[:0], 3)) == 0


def test_search_of_an_empty_table(spark):
    assert topk_search.top_k(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


URLS = ["http://a.example.com/en/1", "https://www.example.com/en/2?x=/en/", "http://EXAMPLE.com/en", "http://shop.net/es/9#t",
        "http://net/fr/x", "ftp://xnet/es/1", "http://shop.net?u=http://q.com/", "no scheme", "", None, "http://", "http:///p",
        "http://a.b.com", "http://a.b.com/", "x://Y.ORG/a//b/?c", "http://net/es"]


def test_rules_by_hand(spark):
    rows = [(i, u, "<p>") for i, u in enumerate(URLS)] + [(3, URLS[3], None), (None, URLS[0], "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("h")).repartition(3)
    got = Counter((r.page_id, r.host, r.path, r.rule) for r in url_filter.judge(df).collect())
    exp = Counter()
    for i, u, _ in rows:
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            raw = re.match(r"[^/?#]*", rest).group()
            host, path = raw.lower(), re.match(r"[^?#]*", rest[len(raw):]).group()
        fits = [r for _, r in url_filter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and path.startswith("/" + r.split("/", 1)[1])]
        exp[i, host, path, max(fits, key=len, default=None)] += 1
    assert got == exp


def test_templates_learn_from_ruled_urls(spark):
    urls = [f"http://shop.net/{x}/{k}" for x in ("es", "fr", "en") for k in range(40)]
    # a branch of another host that holds a mix of pages under no rule
    urls += [f"http://shop.org/es/{k}" for k in range(40)]
    rules = (*url_filter.RULES, *(("block", f"shop.org/bad/{k}/") for k in range(30)))
    urls += [f"http://shop.org/bad/{k}/x" for k in range(36)] + [f"http://shop.org/good/{k}/x" for k in range(36)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {u: r for r in url_filter.judge(df, url_filter.UrlFilter(rules=rules)).collect() for u in [urls[r.page_id]]}
    assert all(got[f"http://shop.org/bad/{k}/x"].verdict == "block" for k in range(36))  # 6 of them by the template alone
    assert got["http://shop.org/bad/33/x"].rule is None and got["http://shop.org/bad/33/x"].template == "/bad/*/x"
    assert all(got[f"http://shop.org/good/{k}/x"].verdict == "allow" for k in range(36))
    assert all(got[f"http://shop.net/en/{k}"].verdict == "allow" for k in range(40))
    assert all(got[f"http://shop.org/es/{k}"].verdict == "allow" for k in range(40))


def verdicts_by_hand(urls, spec):
    """(verdict, template, purity) of urls like http://host/path, path by path down the tree of each host."""
    ruled, paths = {}, {}
    for u in urls:
        host, _, path = u.split("://")[1].partition("/")
        fits = [(len(r), kind) for kind, r in spec.rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and f"/{path}".startswith("/" + r.split("/", 1)[1])]
        ruled[u] = max(fits)[1] if fits else "none"
        paths.setdefault((host, ""), []).append((u, [x for x in path.split("/") if x]))
    count = lambda us: [sum(ruled[u] == k for u, _ in us) for k in ("block", "allow", "none")]
    out, level = {}, 0
    while paths:
        below = {}
        for (host, template), members in paths.items():
            ends = [m for m in members if len(m[1]) == level]
            inner = [m for m in members if len(m[1]) > level]
            for u, _ in ends:
                out[u] = (host, template)
            total = count(inner)
            for seg in {m[1][level] for m in inner}:
                mine = [m for m in inner if m[1][level] == seg]
                part, n, rest = count(mine), len(mine), len(inner) - len(mine)
                chi = sum((a - t * n / len(inner)) ** 2 / (t * n / len(inner))
                          + (t - a - t * rest / len(inner)) ** 2 / (t * rest / len(inner)) for a, t in zip(part, total) if t and rest)
                literal = n >= spec.min_urls and (not rest or chi >= spec.differs)
                below.setdefault((host, f"{template}/{seg if literal else '*'}"), []).extend(mine)
        paths, level = below, level + 1
    groups = {}
    for u, key in out.items():
        groups.setdefault(key, []).append((u, None))
    for u, key in out.items():
        bad, good, _ = count(groups[key])
        purity = bad / (bad + good + spec.prior)
        own = "block" if purity >= spec.reject else "allow"
        out[u] = (ruled[u] if ruled[u] != "none" else own, key[1], pytest.approx(purity))
    return out


def compare_verdicts(spark, urls, rules):
    spec = url_filter.UrlFilter(rules=(*url_filter.RULES, *rules))
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    got = {urls[r.page_id]: (r.verdict, r.template, r.purity) for r in url_filter.judge(df, spec).collect()}
    return got, verdicts_by_hand(urls, spec)


def test_verdicts_by_hand(spark):
    rng = random.Random(21)
    urls = {f"http://h{rng.randrange(6)}.org/{rng.choice('abcd')}/{rng.choice(['x', 'y', rng.randrange(99)])}/{rng.randrange(40)}"
            for _ in range(1500)}
    urls |= {f"http://big.org/bad/{k}" for k in range(500)} | {f"http://thin.org/p/{k}" for k in range(60)}
    rules = [("block", f"big.org/bad/{k}") for k in (11, 13, 21, 22, 23, 24)] + [("block", "thin.org/p/59")]
    rules += [("block", f"h{h}.org/a/x/") for h in (0, 1)] + [("block", f"h2.org/{c}/{k}/") for c in "ab" for k in range(20)]
    rules += [("allow", f"h{h}.org/a/y/") for h in (0, 3)] + [("block", f"h4.org/b/y/{k}") for k in range(3)]
    got, exp = compare_verdicts(spark, sorted(urls), rules)
    assert got == exp
    # a template that is mostly unlabelled is judged by its labelled urls, one blocked url alone does not decide
    assert got["http://big.org/bad/499"][0] == "block" and got["http://thin.org/p/1"][0] == "allow"
    more = sorted(urls | {f"http://big.org/bad/x{k}" for k in range(500)})
    assert compare_verdicts(spark, more, rules)[0]["http://big.org/bad/x7"][0] == "block"


def test_deep_paths_by_hand(spark):
    deep = "/".join("abcdefgh")
    urls = [f"http://d.org/{deep}/{x}/{y}/{k}" for x in ("bad", "good") for y in ("s", "t") for k in range(40)]
    urls += [f"http://d.org/{deep}/bad/s/{k}/" + "/".join("x" * 30) for k in range(20)] + [f"http://d.org/{deep}", "http://d.org/a"]
    urls += [f"http://e.org/{deep}/{k}/{k % 3}" for k in range(30)]  # no rule: the tail cannot matter
    got, exp = compare_verdicts(spark, urls, [("block", f"d.org/{deep}/bad/{y}/{k}") for y in "st" for k in (1, 2)])
    assert {u: v[0] for u, v in got.items()} == {u: v[0] for u, v in exp.items()}
    assert got[f"http://d.org/{deep}/bad/t/39"][0] == "block" and got[f"http://d.org/{deep}/good/t/39"][0] == "allow"
    assert all(got[u] == exp[u] for u in urls if not got[u][1].endswith("**"))
    assert got[urls[-1]][1] == f"/{deep}/**"


def test_urls_of_an_empty_table(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_pipeline_stages_on_planted_rows(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    vocabulary = ["of", "the", "and", "in"] + ["".join(rng.choice("aeioustrnlm") for _ in range(6)) for _ in range(400)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    text = lambda: "\n".join(sentence(25) for _ in range(6))
    rows = [(i, text(), "en", f"src{i % 4}") for i in range(120)]
    copied = rows[0][1]
    rows += [(200, copied, "en", "src0"), (201, copied + " Extra end.", "en", "src1")]
    rows += [(210 + k, "### $$$ %%% " * 60, "en", "src0") for k in range(8)] + [(220, "too short", "en", "src1"), (221, None, "en", None)]
    rows += [(230, text() + " password=abcdef123456", "en", "src2")]
    path = str(tmp_path / "in")
    (spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows],
                           "doc_id long, text string, lang string, source string, n_chars long")
     .write.parquet(f"{path}/documents.parquet"))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
        if name != "pieces":
            assert docs.columns == columns
        docs.write.parquet(out := str(tmp_path / name.replace(" ", "-")))
        docs = spark.read.parquet(out)
        seen.append({r.doc_id: r for r in docs.collect()})
    good, single, clean, mixed, pieces = seen
    assert set(range(120)) | {200, 201, 230} == set(good)  # junk goes, clean documents stay
    assert set(single) == set(good) - {200, 201}
    assert clean[230].text.endswith("[SECRET]") and clean[230].n_chars == len(clean[230].text)
    assert all(clean[i].text == single[i].text for i in clean if i != 230)
    assert set(mixed) <= set(clean) and len(mixed) > 60
    assert set(pieces) == set(mixed)
    assert corpus_pipeline.run(spark, path).select("doc_id").distinct().count() == len(pieces)


def test_pipeline_mix_keeps_small_sources(spark):
    import corpus_pipeline

    rng = random.Random(31)
    sizes = {f"s{k:02d}": n for k, n in enumerate([20, 35, 64, 90, 127, 128, 150, 200, 25, 110, 3000])}
    rows = [(100 * k + j, " ".join(f"w{rng.randrange(500)}" for _ in range(n)), "en", s, 0)
            for k, (s, total) in enumerate(sizes.items()) for j, n in enumerate([total // 2, total - total // 2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken, want = Counter(), {}
    for r in corpus_pipeline.source_mix(spark, docs, "").collect():
        taken[r.source] += len(r.text.split())
    names, weights, capped, goal = sorted(sizes), corpus_pipeline.MIX.weights, {}, 1.5 * sum(sizes.values())
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    while not want:
        rest = [s for s in names if s not in capped]
        level = (goal - sum(capped.values())) / sum(weight[s] for s in rest)
        over = [s for s in rest if 2 * sizes[s] < level * weight[s]]
        capped.update({s: 2 * sizes[s] for s in over})
        want = {} if over else {s: capped.get(s, level * weight[s]) for s in names}
    for s in names:  # rounded to a block, and the last block of a run may be short
        assert taken[s] > 0 and abs(taken[s] - want[s]) <= 2 * corpus_pipeline.MIX.block_words, s


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)] == [1] * 10 and "pipeline" in names


def stages(spark, docs):
    import corpus_pipeline
    from leadlens.llm.common import stored
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        out.append(docs)
        docs = stored(docs, "test-pipeline")
    return out


def test_pipeline_of_an_empty_table(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    got = stages(spark, spark.createDataFrame([], schema))
    assert [d.count() for d in got] == [0] * 5 and got[3].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_pipeline_with_odd_rows_and_clashing_columns(spark):
    rng = random.Random(21)
    say = lambda n: " ".join(rng.choice(["the", "house", "of", "a", "river", "and", "some", "green", "hills", "was", "here"]) + str(rng.choice(["", "s", "ly"]))
                             for _ in range(n)).capitalize() + "."
    texts = [say(120) for _ in range(40)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(100, None, None, None, None), (101, "", "en", "s0", 0), (102, texts[0], "en", "s1", len(texts[0])), rows[1],
             (None, say(90), "en", None, 1), (103, " ".join(f"The river{i} of hills{i} was green." for i in range(9000)), "en", "s2", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("__id__", "__passes__", "measures", "_t0", "posterior", "kept"):
        df = df.withColumn(c, F.lit("x"))
    got = stages(spark, df.repartition(3))
    assert all(d.columns == df.columns for d in got[:4])
    kept = {r.doc_id for r in got[1].collect()}
    assert 102 not in kept and not kept & {100, 101} and 103 in kept
    sampled = got[4].filter("doc_id = 103").collect()
    assert sampled and all(r.n_pieces > 30_000 for r in sampled)
