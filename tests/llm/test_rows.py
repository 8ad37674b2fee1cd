"""Chat, URLs, mixture and the pipeline."""

import random
from collections import Counter, defaultdict
from urllib.parse import urlsplit

import numpy as np
import pytest
from frames import awkward, clashing, values
from harness import connect, difference, oracle_result, spark_result
from pyspark.sql import functions as F

import corpus_pipeline
from venuelens.llm import chat, decontaminate, mixture, queries, sharding, simhash, tables, toxicity, urls

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    actual = spark_result(queries.QUERIES[name](spark, SF_DIR))
    assert difference(actual, oracle_result(connect(SF_DIR), queries.ORACLES[name])) is None


# -- chat -------------------------------------------------------------------
def test_every_speaker_is_assistant_once(spark):
    turns = [
        (1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 2, "bob", "hello <|im_end|>"), (1, 3, "ann", None),
        (1, 3, "ann", None), (2, None, None, "x"), (None, 0, "cat", "no id"), (3, 0, "system", "alone"),
    ]
    got = chat.rotated(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r.conv_id, r.perspective) for r in got if r.conv_id) == [(1, "ann"), (1, "bob"), (2, "unknown")]
    assert [r.perspective for r in got if r.conv_id is None] == ["cat"]
    ann = next(r for r in got if r.perspective == "ann")
    assert ann.text.startswith("<|im_start|>system\nrules<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n")
    assert "<|im_start|>user name=bob\nhello < |im_end|><|im_end|>\n" in ann.text
    assert [ann.text[a:b] for a, b in ann.mask] == ["hi<|im_end|>", "<|im_end|>"]
    assert ann.n_turns == 4 and ann.n_learned == sum(b - a for a, b in ann.mask)


def test_long_dialogues_lose_no_turn(spark):
    rows = [(1, i // 3, f"s{i % 3}", f"text {i}") for i in range(900)]
    got = chat.rotated(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), window=40)
    for who in ("s0", "s1", "s2"):
        own = [r for r in got.collect() if r.perspective == who]
        assert len(own) > 6 and max(r.n_turns for r in own) < 150
        said = [r.text[a:b] for r in own for a, b in r.mask]
        assert sorted(said) == sorted(f"text {i}<|im_end|>" for i in range(900) if f"s{i % 3}" == who)
        assert sum(r.n_turns for r in own) == 900


def test_dialogues_are_cut_by_position(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, i, f"s{i % 2}", f"t{i}") for i in range(64)] + [(2, i, f"s{i % 2}", f"t{i}") for i in range(60, 71)]
    rows += [(3, i, "ann", f"t{i}") for i in (0, 100, 200)] + [(4, None, "ann", f"t{i}") for i in range(65)]
    got = chat.rotated(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.conv_id, r.n_turns) for r in got) == [(1, 64), (1, 64), (2, 11), (2, 11), (3, 3), (4, 1), (4, 64)]
    rows = [(None, 0, "system", "rules")] + [(None, 1 + i // 700, f"s{i % 2}", f"text {i:04}" + "x" * 30) for i in range(1000)]
    got = chat.rotated(spark.createDataFrame(rows, schema)).where("perspective = 's1'").orderBy("window").collect()
    rows = sorted(rows, key=lambda r: r[1:])
    assert [r.window for r in got] == list(range(16)) and sum(r.n_turns for r in got) == 1001
    for r in got:
        low, high = 64 * r.window, 64 * r.window + 64
        shown = ([rows[0]] if low else []) + rows[max(low - 16, 0) : high]
        assert [x.split("\n")[1] for x in r.text.split("<|im_start|>")[1:]] == [f"{t[3]}<|im_end|>" for t in shown]
        assert [r.text[a:b] for a, b in r.mask] == [f"{t[3]}<|im_end|>" for t in rows[low:high] if t[2] == "s1"]


def test_long_dialogues_and_turns_equal_sql(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string, x string, speaker string, said string"
    rows = [(1, i, f"s{i % 2}", f"t{i}") for i in range(65)] + [(2, i // 2, "system" if i % 3 == 0 else f"s{i % 2}", f"t{i} <|") for i in range(300)]
    rows += [(3, i, f"s{i % 3}", "word " * 3000) for i in range(8)] + [(4, 0, "ann", "x" * 200_000), (4, 1, None, None), (4, 1, None, None)]
    rows += [(5, i % 40, "ann", "same") for i in range(80)] + [(None, i, "bob", str(i)) for i in range(70)]
    turns = spark.createDataFrame([(*r, "own", "own", "own") for r in rows], schema)
    turns.coalesce(1).write.parquet(f"{tmp_path}/t")
    (part,) = tmp_path.glob("t/*.parquet")
    part.rename(tmp_path / "conversations.parquet")
    actual = spark_result(chat.digest(chat.rotated(turns)))
    assert difference(actual, oracle_result(connect(tmp_path), chat.ORACLE)) is None


def test_no_turns(spark):
    assert chat.rotated(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# -- urls -------------------------------------------------------------------
def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    tail = rest[end:]
    stop = min((tail.find(c) for c in "?#" if c in tail), default=len(tail))
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    return lowered, tail[:stop]


def plain_rule(host, path):
    fits = [r for r in queries.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def test_parts_and_rules_equal_plain(spark):
    got = queries.op8_urls(spark, SF_DIR).collect()
    of = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    assert len(got) == len(of)
    for r in got:
        host, path = plain_parts(of[r.page_id])
        rule = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.name)
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == rule.verdict)


def test_awkward_urls(spark):
    odd = [None, "", "no mark", "http://", "http://A.Example.NET/en/x?y#z", "x://ÄB.org/fr/", "a://b://c/d", "h://net?q=/",
           "http://net/", "http://xnet/", "h://h#f?x", "http://a.example.com/de/\n1"]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(odd)] * 2, "page_id long, url string, x string")
    got = values(urls.judged(pages, queries.RULES), "page_id", "host", "path")
    assert got == sorted([(i, *plain_parts(u)) for i, u in enumerate(odd)] * 2, key=repr)
    nothing = urls.judged(pages.limit(0), queries.RULES)
    assert nothing.count() == 0 and {"host", "verdict", "x"} <= set(nothing.columns)
    assert urls.judged(pages.where("page_id < 3"), queries.RULES).where("verdict = 'allow'").count() == 6


def walked(node, row):
    while node.feature >= 0:
        node = node.left if row[node.feature] <= node.cut else node.right
    return node.value


def test_trees_equal_their_sql(spark):
    """The margin of every row, walked in Python, against the expression that runs on Spark."""
    random_ = np.random.default_rng(3)
    x = random_.normal(size=(400, len(urls.FEATURES)))
    y = ((x[:, 0] > 0.2) ^ (x[:, 5] > 0)).astype(float)
    prior, trees = urls.fit(x, y)
    margins = [prior + sum(walked(t, row) for t in trees) for row in x]
    assert len(trees) == urls.Settings().rounds and np.mean((np.array(margins) > 0) == (y > 0)) > 0.9
    rows = spark.createDataFrame([(i, *row) for i, row in enumerate(x.tolist())], ["i", *urls.FEATURES])
    margin = " + ".join([f"{prior!r}D", *map(urls._expression, trees)])
    got = [r.m for r in rows.select("i", F.expr(margin).alias("m")).orderBy("i").collect()]
    assert np.allclose(got, margins, rtol=0, atol=1e-9)


def test_trees_tell_held_out_urls(spark):
    """Held-out urls that the rules decide are told better than by the larger class.

    A suffix that the rules give one verdict does not count: with it, this share was 77 %, as the suffix was the label.
    """
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    hosted = pages.withColumn("host", urls.host_of(F.col("url"))).withColumn("path", urls.path_of(F.col("url")))
    rule = urls.rule_of(F.col("host"), F.col("path"), queries.RULES)
    ruled = hosted.withColumn("verdict", urls.verdict_of(rule, queries.RULES)).where("verdict is not null")
    held = F.crc32(F.col("page_id").cast("string")) % 5 == 0
    model = urls.train(ruled.where(~held).select("url", "host", "path", "verdict"), "url", "host", "path", "verdict")
    rated = urls.scored(ruled.where(held), model, "url", "host", "path", "score").collect()
    blocked = np.mean([r.verdict == "block" for r in rated])
    assert np.mean([(r.score > 0.5) == (r.verdict == "block") for r in rated]) > max(blocked, 1 - blocked) + 0.03


def test_a_suffix_of_one_verdict_decides_nothing(spark):
    """All ruled .com pages are blocked, but what tells is the length: .com pages without a rule are judged by it."""
    long = "x" * 60
    made = [(f"http://h{i}.net/{long}{i}" if i % 2 else f"http://a.example.net/en/{i}") for i in range(400)]
    made += [f"http://example.com/de/{long}{i}" for i in range(200)] + [f"http://h{i}.org/fr/{i}" for i in range(200)]
    open_ = [f"http://h{i}.com/{long if i % 2 else 'y'}/{i}" for i in range(100)]
    pages = spark.createDataFrame(list(enumerate(made + open_)), "page_id long, url string")
    got = urls.judged(pages, queries.RULES).where("rule is null").collect()
    assert len(got) == 100 and all((r.verdict == "block") == (len(r.url) > 60) for r in got)
    assert urls.known_suffixes([(1, 0, 4), (1, 2, 2), (2, 5, 5), (3, 0, 9)], 0.5) == {1: ((2 + 2.5) / 11, float(np.log1p(6)))}


def test_trees_of_few_urls_with_many_rows(spark):
    """Ten urls in 50,000 rows, and one url with a third of the rows, give the trees that their counts give."""
    ten = [f"http://h{i}.example.{'net' if i < 5 else 'org'}/{'a' if i < 5 else 'fr'}/{'x' * i}" for i in range(10)]
    pages = spark.range(50_000).select("id", F.element_at(F.array(*map(F.lit, ten)), (F.col("id") % 10 + 1).cast("int")).alias("url"))
    hot = pages.limit(25_000).withColumn("url", F.lit("http://hot.org/fr/")).unionByName(
        spark.range(50_000).select("id", F.concat(F.lit("http://h"), "id", F.when(F.col("id") % 2 == 0, ".net/a").otherwise(".org/fr/")).alias("url"))
    )
    for given, urls_seen in ((pages, 10), (hot, 20_000)):
        named = given.select("url", urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path"))
        ruled = named.withColumn("verdict", urls.verdict_of(urls.rule_of(F.col("host"), F.col("path"), queries.RULES), queries.RULES))
        sizes = []
        fitted, urls.fit = urls.fit, lambda x, y, *a: (sizes.append((len(y), y.mean())), fitted(x, y, *a))[1]
        try:
            model = urls.train(ruled, "url", "host", "path", "verdict")
        finally:
            urls.fit = fitted
        assert len(model.trees) == urls.Settings().rounds
        assert sizes[0][0] == urls_seen and 0.3 < sizes[0][1] < 0.7


# -- mixture ----------------------------------------------------------------
def filled(budget, children):
    """{name: given} by raising one multiple of the weights until the budget is gone."""
    given = dict.fromkeys(children, 0.0)
    open_ = {n for n, (w, holds) in children.items() if w > 0 and holds > 0}
    while open_ and budget > 1e-9:
        total = sum(children[n][0] for n in open_)
        step = min((children[n][1] - given[n]) / children[n][0] for n in open_)
        step = min(step, budget / total)
        for n in open_:
            given[n] += step * children[n][0]
        budget -= step * total
        open_ = {n for n in open_ if children[n][1] - given[n] > 1e-9}
    return given


def test_budgets_fill_siblings_before_ancestors(spark):
    pick = random.Random(8)
    leaves = [(f"d{i % 3}", f"l{j}", f"s{k}", pick.choice([0, 5, 40, 300, 2000])) for i in range(3) for j in range(3) for k in range(4)]
    weights = {"domain": {"d0": 3.0, "d1": 0.5}, "lang": {"l0": 2.0, "l2": 0.0}}
    for share in (0.2, 0.7, 1.5, 9.0):
        mix = mixture.Mix(("domain", "lang", "source"), weights, share=share, epochs=3)
        table = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
        got = {(r.domain, r.lang, r.source): r.quota for r in mixture.budgets(table, mix).collect()}

        def divide(budget, rows, depth):
            if depth == 3:
                return {r[:3]: budget for r in rows}
            families = defaultdict(list)
            for r in rows:
                families[r[depth]].append(r)
            level = ("domain", "lang", "source")[depth]
            children = {n: (weights.get(level, {}).get(n, 1.0), 3.0 * sum(r[3] for r in f)) for n, f in families.items()}
            out = {}
            for name, given in filled(budget, children).items():
                out |= divide(given, families[name], depth + 1)
            return out

        want = divide(share * sum(r[3] for r in leaves), leaves, 0)
        assert all(abs(got[leaf] - want[leaf]) <= 1.01 for leaf in want), share


def test_leaves_take_prefixes_of_seeded_epochs(spark):
    docs = clashing(awkward(spark)).drop("domain").withColumn("domain", mixture.domain(F.col("source")))
    mix = mixture.Mix(queries.LEVELS, queries.WEIGHTS, share=0.7, epochs=2)
    taken = mixture.mixed(docs, mix).collect()
    total = sum(len((r.text or "").split()) for r in docs.collect())
    assert 0 < sum(r.tokens for r in taken) <= 0.7 * total
    levels = {c: F.col(c) for c in queries.LEVELS}
    kept = mixture.keep_mixed(docs, mix, levels)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in taken)
    everything = mixture.Mix(queries.LEVELS, share=1.0, epochs=1)
    assert mixture.keep_mixed(docs, everything, levels).count() == docs.count()
    assert mixture.mixed(docs.limit(0), mix).count() == 0
    assert mixture.keep_mixed(docs.limit(0), mix, levels).count() == 0


# -- pipeline ---------------------------------------------------------------
def test_pipeline_equals_its_stages_by_brute_force(spark):
    from test_simhash import near, plain_components, plain_fingerprint

    docs = tables.read(spark, SF_DIR, "documents")
    model = queries.toxicity_model(spark, SF_DIR, docs)
    rows = [r for r in docs.collect() if toxicity.predict(model, [toxicity.terms(r.text)])[0] < 0.5]
    prints = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    root = plain_components(set(prints.values()), near)
    least = {}
    for i, fp in prints.items():
        least[root[fp]] = min(i, least.get(root[fp], i))
    rows = [r for r in rows if least[root[prints[r.doc_id]]] == r.doc_id]
    bench = [decontaminate.normal(r.text) for r in tables.read(spark, SF_DIR, "benchmark").collect()]
    rows = [r for r in rows if not any(t in decontaminate.normal(r.text) for t in bench)]
    left = spark.createDataFrame(rows, docs.schema).withColumn("domain", mixture.domain(F.col("source")))
    chosen = {r.doc_id for r in mixture.mixed(left, corpus_pipeline.MIX).collect()}
    want = sorted((r.doc_id, r.text) for r in rows if r.doc_id in chosen)
    got = corpus_pipeline.run(spark, SF_DIR)
    assert values(got, "doc_id", "text") == sorted(want, key=repr)
    assert got.columns == [*docs.columns, "size", "shard"]
    sizes = Counter(r.shard for r in got.collect())
    assert set(sizes) == set(range(sharding.SHARDS))


def test_stages_take_awkward_rows_and_empty_tables(spark):
    for docs in (clashing(awkward(spark)), awkward(spark).limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
        assert last.count() == docs.count() and "shard" in last.columns
    assert simhash.keep_one(awkward(spark)).count() < awkward(spark).count()
