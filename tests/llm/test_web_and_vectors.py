import io
import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableferry.llm import hash_index, url_rules, warc_zip
from tableferry.llm.queries import URL_RULES


def plain_verdict(url, rules, default="allow"):
    if not url or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(r.name), r.name, r.verdict), default=None)
    return host, path, best.name if best else None, best.verdict if best else default


def test_urls_match_plain_rules(spark):
    rng = random.Random(2)
    hosts = ["a.example.org", "EXAMPLE.org", "org", "x.com", "com", "notexample.org", "example.org.evil.net", "a..org", "ÉX.com", ""]
    paths = ["", "/", "/es", "/es/", "/en/1", "/en/12/x", "/en/2", "/fr/", "/de/a?b=/fr/", "?x", "#y", "//fr/", "/\nfr/"]
    urls = [f"{s}://{h}{p}" for s in ("http", "HTTPS") for h in hosts for p in paths]
    urls += [None, "", "no scheme/com/fr/", "://", "a://b://c.org/", "http://x.com:80/fr/"]
    rows = [(i, u, "h", "r") for i, u in enumerate(urls)] + [(0, urls[0], "h", "r"), (None, rng.choice(urls), "h", "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    found = url_rules.judge_urls(pages, URL_RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(r["url"], URL_RULES)


def test_many_rules_run_few_patterns(spark):
    rules = [url_rules.Rule(f"site{i}.com", f"/p{i}/", "block") for i in range(500)] + [url_rules.Rule("com", "/", "allow")]
    pages = spark.createDataFrame([(f"http://www.site{i % 600}.com/p{i % 600}/x",) for i in range(1200)], "url string")
    found = url_rules.judge_urls(pages, rules).collect()
    assert all((r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(r["url"], rules) for r in found)
    assert max(r["patterns_run"] for r in found) <= 2


def test_urls_of_an_empty_table(spark):
    assert url_rules.judge_urls(spark.createDataFrame([], "url string"), URL_RULES).count() == 0


@pytest.mark.parametrize("force64", [False, True])
def test_packages_open_elsewhere_and_here(force64):
    out = io.BytesIO()
    package = warc_zip.PackageWriter(out.write, force64)
    package.begin("a")
    assert [package.data(b"one"), package.data(b"two")] == [0, 3]
    package.end()
    package.begin("é/b")
    package.end()
    package.close()
    data = out.getvalue()
    with zipfile.ZipFile(io.BytesIO(data)) as other:
        assert other.testzip() is None and other.read("a") == b"onetwo"
    read = lambda at, size: data[at : at + size]
    members = warc_zip.read_directory(read, len(data))
    assert list(members) == ["a", "é/b"]
    start = warc_zip.data_start(read, members["a"])
    assert data[start : start + members["a"].size] == b"onetwo"


def test_packages_of_others_are_read(tmp_path):
    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("s", b"stored")
        z.writestr("d", b"deflated" * 50, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 inside"
    data = path.read_bytes()
    read = lambda at, size: data[at : at + size]
    members = warc_zip.read_directory(read, len(data))
    at = warc_zip.data_start(read, members["s"])
    assert data[at : at + 6] == b"stored"
    with pytest.raises(ValueError, match="not stored"):
        warc_zip.data_start(read, members["d"])
    with pytest.raises(ValueError, match="no end"):
        warc_zip.read_directory(lambda at, size: b"", 0)


@pytest.mark.parametrize("package_bytes", [1, 2000, 1 << 30])
def test_records_come_back(spark, package_bytes):
    long, short = "ü" * 60, "s" * 99
    rows = [(1, "http://a/", long), (3, "http://b/é\r\nX: y", long), (3, "u", long), (2, None, short), (4, "u", short),
            (5, "u", None), (6, "u", ""), (None, "u", long), (None, "u", "only" * 50), (7, "u", "line\r\n\r\nline" * 100_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x")).repartition(3)
    folder = warc_zip.new_folder(pages)
    packages = warc_zip.write_packages(pages, folder, package_bytes=package_bytes)
    assert packages.agg(F.sum("records")).first()[0] == len(rows)
    found = warc_zip.read_packages(packages, folder, with_payload=True).collect()
    got = sorted(((r["page_id"] or "", r["payload_bytes"], r["record_type"], r["refers_to"]) for r in found), key=repr)
    size = lambda t: len((t or "").encode())
    expected = [
        (str(i) if i else "", size(t), "revisit" if t == long and i != 1 else "response", "1" if t == long and i != 1 else None)
        for i, _, t in rows
    ]
    assert got == sorted(expected, key=repr)
    for r in found:
        if r["record_type"] == "response":
            assert len(r["payload"]) == r["payload_bytes"]


@pytest.mark.parametrize("hot", ["same " * 40, ""])
def test_a_payload_on_a_third_of_the_pages_is_split(spark, tmp_path, small_skew, final_plan, hot):
    own = F.concat(*[F.sha2(F.concat_ws("-", F.lit(i), "page_id").cast("binary"), 512) for i in range(4)])
    pages = spark.range(30_000).withColumnRenamed("id", "page_id")
    pages = pages.withColumn("html", F.when(F.col("page_id") % 3 == 0, F.lit(hot)).otherwise(own)).withColumn("url", own)
    pages.union(pages.where("page_id % 3 = 1")).repartition(10).write.parquet(str(tmp_path / "pages"))
    marked = warc_zip.mark_revisits(spark.read.parquet(str(tmp_path / "pages")), "page_id", "url", "html")
    plan = final_plan(marked)
    assert "SortMergeJoin(skew=true)" in plan if hot else "SortMergeJoin" in plan
    assert marked.count() == 40_000
    # of the hot payload the first id is none, nor are those of a pair, which have one id
    assert marked.where("refers_to is not null").count() == (9_999 if hot else 0)
    if not hot:
        held = marked.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in held) < 10_000


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = warc_zip.new_folder(pages)
    assert warc_zip.read_packages(warc_zip.write_packages(pages, folder), folder).count() == 0


VEC = "vec_id long, embedding array<float>, vec string, block int"


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hash_index, "BLOCK_ROWS", 500)
    monkeypatch.setattr(hash_index, "QUERY_ROWS", 40)
    rng = np.random.default_rng(1)
    rows = rng.standard_normal((2000, 24)).astype(np.float32) * rng.uniform(0.5, 2, (2000, 1)).astype(np.float32)
    rows[100:400] = rows[100]  # a vector on many rows
    df = spark.createDataFrame([(i, r.tolist(), "x", 1) for i, r in enumerate(rows)], VEC)
    found = hash_index.search(df, F.col("vec_id") % 20 == 0, k=10, fit_rows=800).toPandas()
    hits = 0
    for q in range(0, 2000, 20):
        scores = (rows.astype(float) * rows[q].astype(float)).sum(axis=1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(2000), -scores))[:10]
        mine = found[found.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 11))
        assert np.allclose(mine.score, scores[mine.vec_id])
        assert list(zip(-mine.score, mine.vec_id)) == sorted(zip(-mine.score, mine.vec_id))
        hits += len(set(best) & set(mine.vec_id))
    assert hits / 1000 >= 0.9


def table_of(spark, rows):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, vec array<double>")


@pytest.mark.parametrize("spread", [0.02, 0.2, 1.0])
def test_every_code_within_the_radius_is_found(spark, monkeypatch, spread):
    monkeypatch.setattr(hash_index, "BLOCK_ROWS", 150)
    monkeypatch.setattr(hash_index, "QUERY_ROWS", 20)
    rng = np.random.default_rng(3)
    rows = np.repeat(rng.standard_normal((60, 40)), 20, axis=0) + spread * rng.standard_normal((1200, 40))
    rows[200:600] = rows[200]  # a third of the rows, all in one cut of each substring
    codes = hash_index.fit(rows, float(np.sqrt((rows**2).sum(axis=1).max())), 5)
    whole = table_of(spark, rows)
    index, probes = hash_index.indexed(whole, codes, 6), hash_index.probing(whole.where("vec_id % 30 = 1"), codes, 6)
    coded = codes.of(hash_index._lift(rows, codes.longest))
    aimed = codes.of(hash_index._aim(rows, codes.longest))
    expected = set()
    for q in range(1, 1200, 30):
        near = np.flatnonzero(hash_index.distances(coded, aimed[q]) <= codes.radius(q, aimed[q]))
        assert len(near) > 5
        expected |= {(q, int(i)) for i in near if i != q}
    got = [tuple(r) for r in hash_index.retrieve(index, probes, 6, None).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    # the coarse vectors lose none of the nearest
    few = {tuple(r) for r in hash_index.retrieve(index, probes, 6, 5).collect()}
    assert few <= expected
    for q in range(1, 1200, 30):
        mine = np.array(sorted(i for a, i in expected if a == q))
        top = mine[hash_index.best(hash_index.products(rows[mine], rows[q]), mine, 5)]
        worst = hash_index.products(rows[top], rows[q]).min()
        clear = {(q, int(i)) for i in top if hash_index.products(rows[[i]], rows[q])[0] > worst + 1e-9}
        assert clear <= few


@pytest.mark.parametrize("radius", [0, 3, 15, 16, 40, 100, 256])
@pytest.mark.parametrize("depth", [0, 5, 16])
def test_reaches_miss_no_code(radius, depth):
    reach = hash_index.reaches(radius, depth)
    # whatever way the differing bits are dealt out, one substring is within its reach
    assert (reach + 1).sum() > radius or reach.max() == hash_index.SUBSTRING_BITS
    if depth == 16 and radius < 40:
        assert reach.max() <= 2


def test_near_copies_meet_few_rows(spark, monkeypatch):
    monkeypatch.setattr(hash_index, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(4)
    rows = np.repeat(rng.standard_normal((200, 32)), 30, axis=0) + 0.002 * rng.standard_normal((6000, 32))
    rows /= np.sqrt((rows**2).sum(axis=1, keepdims=True))
    codes = hash_index.fit(rows, float(np.sqrt((rows**2).sum(axis=1).max())), 10)
    probes = hash_index.probing(table_of(spark, rows).where("vec_id % 60 = 0"), codes, 11)
    assert all(r["radius"] < 48 for r in probes.collect())
    keys = hash_index.indexed(table_of(spark, rows), codes, 11).select(F.explode("keys").alias("key"))
    met = keys.join(probes.select("query_id", F.explode("keys").alias("key")), "key").count()
    assert met < 0.2 * 100 * 6000
    index = hash_index.indexed(table_of(spark, rows), codes, 11)
    assert hash_index.retrieve(index, probes, 11, None).count() < 0.02 * 100 * 6000


@pytest.mark.parametrize("tight", [0.5, 0.9])
def test_neighbours_where_ids_follow_the_source(tight):
    rng = np.random.default_rng(8)
    n, k = 6000, 10
    copies = int(n * tight)
    rows = np.repeat(rng.standard_normal((copies // 100, 32)), 100, axis=0)
    rows = np.r_[rows + 0.01 * rng.standard_normal(rows.shape), rng.standard_normal((n - copies, 32))]
    codes = hash_index.fit(rows, float(np.sqrt((rows**2).sum(axis=1).max())), k)
    coded = codes.of(hash_index._lift(rows, codes.longest))
    for part in (range(0, copies, copies // 50), range(copies, n, (n - copies) // 50)):
        hits = 0
        for q, code in zip(part, codes.of(hash_index._aim(rows[part], codes.longest))):
            scores = hash_index.products(rows, rows[q])
            scores[q] = -np.inf
            within = hash_index.distances(coded, code) <= codes.radius(q, code)
            hits += within[hash_index.best(scores, np.arange(n), k)].sum()
        assert hits / (k * len(part)) >= 0.9


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [1.0, None]), (None, [1.0, 1.0]), (8, [1.0]), (9, []), (20, [0.0, 2.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VEC)
    found = hash_index.search(df, F.col("vec_id") % 20 == 0, k=20).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found)
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, 0.5), (0, 3, 20, 0.0), (20, 1, 1, 1.0), (20, 2, 2, 1.0), (20, 3, 0, 0.0)]


def test_no_vectors(spark):
    assert hash_index.search(spark.createDataFrame([], VEC), F.col("vec_id") % 20 == 0).count() == 0
    zero = spark.createDataFrame([(0, [0.0], "x", 1)], VEC)
    assert hash_index.search(zero, F.col("vec_id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0], "x", 1)], VEC)
    assert hash_index.search(alone, F.col("vec_id") % 20 == 0).count() == 0
