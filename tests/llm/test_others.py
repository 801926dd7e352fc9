import gzip
import random
import tracemalloc
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tallybook.llm import components, ngram_join, quality, queries, topk_search, toxicity, url_filters, warc
from tallybook.plans.durable import written_table
from tests import oracle
from tests.llm.cases import TEXTS, documents, rows

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", [n for n in queries.oracle_sql()])
def test_query_matches_sql(spark, con, name):
    assert oracle.compare(queries.queries()[name](spark, SF), con, queries.oracle_sql()[name]) == []


def test_components_of_a_path(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (5, 5), (None, 3), (101, 100)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    want = [(i, 0) for i in range(61)] + [(100, 100), (101, 100)]
    assert sorted(map(tuple, found.collect())) == want


def brute_top(ids, vectors, every, k):
    out = []
    for i, v in zip(ids, vectors):
        if i % every == 0:
            scored = sorted((-int(np.dot(v, w)), j) for n, (j, w) in enumerate(zip(ids, vectors)) if w is not v)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["normal", "ties", "few"])
def test_top_k(spark, kind):
    rng = np.random.default_rng(3)
    x = {"normal": rng.normal(0, 0.2, (900, 12)), "ties": rng.integers(-1, 2, (400, 4)) / 2, "few": rng.normal(size=(3, 2))}[kind]
    data = [(i, v, 1) for i, v in enumerate(x.tolist())]
    awkward = [(50_000, None, 1), (50_050, [1.0, None], 1), (50_100, [float("nan")], 1), (50_150, [float("inf")], 1), (None, [1.0], 1)]
    df = spark.createDataFrame(data + awkward, "vec_id long, embedding array<double>, row int")
    found = topk_search.top_k(df, 50, 5, block_rows=150, block_queries=4)
    whole = [np.floor(256 * np.array(v)).astype(np.int64) for _, v, _ in data]
    assert sorted(map(tuple, found.collect())) == brute_top([i for i, _, _ in data], whole, 50, 5)
    assert rows(topk_search.top_k(df.limit(0))) == []


def test_lists_are_read_once_for_all_queries(monkeypatch):
    rng = np.random.default_rng(5)
    rows = np.floor(256 * rng.normal(0, 0.2, (3_000, 16))).astype(np.int64)
    queries, own = np.vstack([rows[:40], np.zeros((1, 16), np.int64)]), np.array([*range(40), -1])
    depths = []
    read = topk_search.SortedLists.read
    monkeypatch.setattr(topk_search.SortedLists, "read", lambda self, depth: (depths.append(depth), read(self, depth))[1])
    lists = topk_search.SortedLists(rows)
    found = topk_search.no_random_access(lists, queries, 5, own, np.full(41, -np.inf))
    assert 0 < len(depths) <= 4 and len(found[40]) == 3_000
    for q, (query, kept) in enumerate(zip(queries[:40], found)):
        scores = rows @ query
        scores[q] = -(1 << 62)
        assert set(np.argsort(-scores)[:5]) <= set(kept) and q not in kept and len(kept) < 1_000
        floor = float(np.sort(scores)[-3])
        wanted = topk_search.no_random_access(lists, queries[q : q + 1], 5, own[q : q + 1], np.array([floor]))[0]
        assert set(np.flatnonzero(scores >= floor)) <= set(wanted)


def test_top_k_of_repeated_ids(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (7, [0.5])], "vec_id long, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk_search.top_k(df).collect())
    assert got == [(0, 1, 0, 65536)] * 2 + [(0, 2, 7, 32768)] * 2


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://example.com/en/", "https://a.b.example.com/en",
    "http://example.com", "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/es", "http://net/fr/?a/b", "a://b://c/d",
    "http://com/", "http://.com/", "http://user@www.example.com:80/en/", "http://x.org/en/", "http://deep.www.example.com/en/q/r",
]


def brute_url(url, rules, default):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("rules", [
    url_filters.QUERY_RULES,
    [("com", "", "block"), ("example.com", "/en/", "allow"), ("example.com", "/e", "block"), ("b.example.com", "/", "allow"), ("org", "/en/", "block")],
])
def test_url_filters(spark, rules):
    data = [(i, u, "k", 3) for i, u in enumerate(URLS)] + [(3, URLS[5], "k", 3), (None, URLS[4], "k", 3)]
    pages = spark.createDataFrame(data, "page_id long, url string, key string, row int").repartition(3)
    given = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = url_filters.judge_urls(pages, given, default="allow", ranges=4)
    want = [(i, *brute_url(u, rules, "allow")) for i, u, _, _ in data]
    assert rows(found) == sorted(want, key=str)
    assert rows(url_filters.judge_urls(pages.limit(0), given)) == []
    assert found.count() == url_filters.judge_urls(pages, given.limit(0)).where("rule IS NULL").count()


def test_url_filters_stay_in_the_jvm(spark):
    plan = queries.queries()["op3_url_filters"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "NestedLoop", "Cartesian"))


def test_warc(spark, tmp_path):
    big, data = "<p>" + "é" * 800, []
    for i in range(40):
        data.append((i, f"http://h{i % 3}.example.com/a?{i}", big if i % 4 == 0 else f"page {i}", "x"))
    data += [(90, None, big, "x"), (91, "http://h/\r\nx", None, "x"), (None, "http://n/", big, "x"), (36, "http://again/", big, "x"), (92, "u", "", "x")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, file string").repartition(3)
    location = str(tmp_path / "archive")
    found = warc.archive_pages(pages, location=location)
    import hashlib

    want = []
    for i, _, html, _ in data:
        body = (html or "").encode()
        first = 90 if html == big else i
        again = len(body) >= 1000 and i != first
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", first if again else None))
    assert rows(found) == sorted(want, key=str)
    files = list((tmp_path / "archive").glob("*.warc.gz"))
    records = [r for f in files for r in gzip.open(f).read().split(b"WARC/1.1\r\n")[1:]]
    assert len(records) >= len(data)
    assert rows(warc.archive_pages(pages.limit(0), location=str(tmp_path / "none"))) == []


def test_warc_index_in_small_blocks(spark):
    captures = [(warc.key_of(f"http://a{i % 7}.x.com/{i}"), i, f"f{i % 5}", 10 * i, 10) for i in range(500)]
    table = spark.createDataFrame(captures, "key string, row long, file string, offset long, length long")
    index = warc.build_index(table, block_lines=9, ranges=5)
    wanted = table.where("row % 3 = 0").select("key", "row")
    missing = spark.createDataFrame([("nowhere)", 1), ("com,x,a3)/9999", 2)], "key string, row long")
    got = sorted(map(tuple, warc.find(index, wanted.union(missing), ranges=4).collect()))
    assert got == sorted(c for c in captures if c[1] % 3 == 0)


@pytest.mark.parametrize("operator,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers(spark, con, operator, label):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = operator.score(docs, labels)
    held = scored.join(labels, "doc_id").where("held_out").select("score", label).collect()
    assert all(zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in scored.where("held_out").select("doc_id").collect())
    right = [s for s, y in held if y]
    wrong = [s for s, y in held if not y]
    better = np.mean([a > b for a in right for b in wrong])
    assert better > 0.9, better


@pytest.mark.parametrize("operator,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_awkward_rows(spark, operator, label):
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(TEXTS))] + [(None, 1), (3, None), (4, 9)], f"doc_id long, {label} int")
    for given in (labels, labels.limit(0), labels.where(f"{label} = 1")):
        scored = operator.score(documents(spark), given)
        assert scored.count() == len(TEXTS) and scored.where("score >= 0 AND score <= 1").count() == len(TEXTS)
    ids = [None, 3, 3, *range(10, 10 + len(TEXTS) - 3)]
    assert operator.score(documents(spark, ids), labels).count() == len(TEXTS)
    assert rows(operator.score(documents(spark).limit(0), labels)) == []
    keep = getattr(operator, "keep_clean", None) or operator.keep_good
    assert keep(documents(spark), labels).columns == documents(spark).columns


def test_pairs_of_terms_are_learned():
    """Neither term alone is toxic; both together are."""
    sample = [(b"group", 0), (b"insult", 0), (b"group insult", 1), (b"nothing", 0)] * 60
    model = toxicity.fit(sample)
    place = model.place()
    score = [model.scores(place, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t, _ in sample[:4]]
    assert score[2] > 0.5 > max(score[0], score[1], score[3])


def test_pairs_of_neutral_terms_are_learned():
    """Each word is in as many toxic texts as clean ones; only the pair tells."""
    kinds = [("insult group", 1), ("praise chair", 1), ("insult chair", 0), ("praise group", 0)]
    draw = random.Random(3)
    sample = []
    for i in range(1200):
        text, label = kinds[i % 4]
        words = text.split() + draw.choices("alpha beta gamma delta kappa sigma omega theta".split(), k=5)
        draw.shuffle(words)
        sample.append((" ".join(words).encode(), label))
    model = toxicity.fit(sample[:1000])
    place = model.place()
    score = [model.scores(place, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t, _ in sample[1000:]]
    assert np.mean([(s >= 0.5) == y for s, (_, y) in zip(score, sample[1000:])]) > 0.95


def test_pair_sum_is_that_of_all_pairs():
    """The score's one pass over the terms gives the sum of the inner products of all pairs of different terms."""
    model = toxicity.fit([(b"group", 0), (b"insult", 0), (b"group insult", 1), (b"nothing", 0)] * 60)
    place = model.place()
    for text in (b"", b"group", b"group insult nothing", b"insult insult group unknown"):
        data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
        rows = sorted({int(place[b]) for b in toxicity.term_buckets(data, offsets)[0]} - {-1})
        total = model.bias + sum(model.weights[r] for r in rows)
        total += sum(model.vectors[a] @ model.vectors[b] for i, a in enumerate(rows) for b in rows[:i])
        assert model.scores(place, data, offsets)[0] == pytest.approx(1 / (1 + np.exp(-total)), rel=1e-9)


def test_long_texts_in_pieces(monkeypatch):
    text = np.frombuffer((TEXTS[10] or "").encode(), np.uint8)
    network = quality.Network()
    whole = network.evidence(text)
    monkeypatch.setattr(quality, "_PIECE", 1 << 13)
    assert network.evidence(text) == pytest.approx(whole, rel=1e-4)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, columns = docs, docs.dtypes
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name.replace(" ", "-"))
        stage(spark, kept, SF).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.dtypes == columns and 0 < after.count() <= kept.count()
        kept = after
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1 AND toxic = 0").collect()}
    first = spark.read.parquet(str(tmp_path / "quality"))
    assert len(good - {r["doc_id"] for r in first.select("doc_id").collect()}) <= 0.02 * len(good)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert packed.select("doc_id").distinct().count() == kept.count()
    assert corpus_pipeline.run(spark, SF).columns == packed.columns


def test_components_joined_by_further_links(spark):
    links = [(0, 1), (1, 2), (5, 6), (9, 8), (20, 21)]
    further = [(2, 6), (30, 31), (31, 20), (8, 40), (1, 0), (7, 7), (41, 42), (42, 43), (None, 3)]
    frame = lambda rows: written_table(spark.createDataFrame(rows, "a long, b long"), "links")
    named = components.components(frame(links))
    found = sorted(map(tuple, components.joined(named, frame(further)).collect()))
    assert found == sorted(map(tuple, components.components(frame(links + further)).collect()))
    assert components.joined(named, frame([(7, 7)])) is named
    assert sorted(map(tuple, components.joined(components.components(frame([])), frame(links)).collect())) == sorted(
        map(tuple, named.collect())
    )


def test_near_duplicates_look_at_each_link_once(spark, monkeypatch):
    """Links of families are not gone through again when links across them are found."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(900)}" for _ in range(60)]
    texts = [" ".join([*base[:i], f"x{i}", *base[i + 1 :]]) for i in range(0, 60, 2)]
    seen, real = [], components.components
    monkeypatch.setattr(components, "components", lambda links: seen.append(links.count()) or real(links))
    monkeypatch.setattr(ngram_join, "components", components.components)
    found = ngram_join.ngram_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 2, 80)
    assert [r["component_id"] for r in found.collect()] == [0] * len(texts)
    assert seen[0] > sum(seen[1:])


def test_toxicity_learns_in_little_memory():
    """The driver keeps no array for every pair of text and term."""
    rng = np.random.default_rng(0)
    names = np.array([f"word{i}" for i in range(3000)])
    sample = [(" ".join(rng.choice(names, 200)).encode(), int(i % 2)) for i in range(1500)]
    tracemalloc.start()
    try:
        toxicity.fit(sample)
        assert tracemalloc.get_traced_memory()[1] < 60 << 20
    finally:
        tracemalloc.stop()
