import json
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.functions import arrays, cleaning, text
from quillmill.functions.udfs import cut_long, nfkc, packed
from quillmill.operators import audit, dataset, dedupe, identify, lines, metadata
from quillmill.plans import catalog
from quillmill.session import broadcast_if_small, materialise
from quillmill.sources import files, harvest, jsonl, oai
from quillmill.streaming.ingest import compacted, ingest


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


def test_text_functions(spark):
    assert one(spark, " a  b\n", text.squeeze) == "a b"
    assert one(spark, "https://doi.org/10.1234/AB.", text.doi_normal) == "10.1234/ab"
    assert one(spark, "see 10.1234/x.y), ok", text.doi_found) == "10.1234/x.y"
    assert one(spark, "none here", text.doi_found) is None
    assert one(spark, "c2019-2021", text.year_found) == 2019
    assert one(spark, "2099", text.year_found) is None
    assert one(spark, "", text.hangul_ratio) == 0.0
    assert one(spark, "가 a", text.hangul_ratio) == 0.5
    assert one(spark, "A b. C d! E", text.sentences) == ["A b.", "C d!", "E"]
    assert one(spark, "x {\"a\": 1} y", text.json_object) == '{"a": 1}'
    assert one(spark, "N/A", text.null_words) is None
    assert one(spark, "중소기업_연구_보고_2020123456789.pdf", text.file_title) is not None
    assert one(spark, "ＡＢ１", nfkc) == "AB1"
    assert one(spark, None, text.squeeze) is None


def test_arrays(spark):
    assert one(spark, ["A", "a", " ", "b"], arrays.distinct_ci, "array<string>") == ["A", "b"]
    assert one(spark, [], arrays.distinct_ci, "array<string>") == []
    assert one(spark, "abab", arrays.bigrams) == ["ab", "ba"]
    assert one(spark, "", arrays.bigrams) == []
    assert one(spark, "a, b;a|c", arrays.split_people) == ["a", "b", "c"]


def test_keep_first_last_and_groups(spark):
    d = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", None)], "_ord int, k string, v string")
    assert {(r.k, r.v) for r in dedupe.keep_first(d, ["k"]).collect()} == {("a", "x"), ("b", None)}
    assert {(r.k, r.v) for r in dedupe.keep_last(d, ["k"]).collect()} == {("a", "y"), ("b", None)}
    assert dedupe.keep_last(d.limit(0), ["k"]).count() == 0
    g = dedupe.key_groups(d, F.col("k"), "_ord", "K").collect()
    assert {(r.member, r.first_member, r.n) for r in g} == {(1, 1, 2), (2, 1, 2)}


def test_fuzzy_pairs_against_brute_force(spark):
    rng = random.Random(1)
    base = ["스마트 공장 도입 효과 분석", "digital twins and firm survival", "빅데이터 활용 수준과 성과"]
    rows = []
    for i in range(24):
        t = list(rng.choice(base))
        if rng.random() < 0.6:
            t[rng.randrange(len(t))] = "x"
        rows.append((i, "".join(t), rng.choice([2020, 2021, None]), rng.choice(["kim", "lee", None])))
    want = set()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and (a[2] and a[2] == b[2] or a[3] and a[3] == b[3]) and SequenceMatcher(None, a[1], b[1]).ratio() >= 0.92:
                want.add((a[0], b[0]))
    got = dedupe.fuzzy_pairs(spark.createDataFrame(rows, "id int, t string, y int, au string"), "id", "t", "y", "au")
    assert {(r.id, r.id2) for r in got.collect()} == want and want


def test_lines(spark):
    doc = "머리글\n서론\n첫 줄이 이어\n진다.\n12\n머리글\n머리글\n머리글\n결론\n끝났다."
    d = spark.createDataFrame([(1, doc), (2, ""), (3, None)], "id int, t string")
    assert {(r.line, r.n) for r in lines.repeated_lines(d, "id", "t").collect()} == {("머리글", 4)}
    got = {r.id: r.f for r in d.select("id", cleaning.drop_furniture(F.col("t")).alias("f")).collect()}
    assert got[1].text == "서론\n첫 줄이 이어\n진다.\n결론\n끝났다." and got[1].removed == 5 and got[1].repeated == ["머리글"]
    assert got[2].text == "" and got[3].text is None
    secs = [tuple(x) for x in d.where("id = 1").select(cleaning.split_sections(F.col("t")).alias("s")).first().s]
    assert [x[0] for x in secs] == ["front_matter", "introduction", "conclusion"] and secs[2] == ("conclusion", "결론", "끝났다.")


def test_cleaning():
    assert cleaning.normalised("Ａ\ufeff\n\n \n===== PAGE 3 =====\nb  \n") == "A\n\nb"
    assert cleaning.line_repaired("서론\n첫 줄이 이어\n진다.\n다음 문장.\n\n\nx\n끝") == "서론\n첫 줄이 이어 진다.\n다음 문장.\n\nx\n끝"
    assert cleaning.section_of("제 2 장 연구 방법 및 자료") == "methodology" and cleaning.section_of("이 논문은 " + "긴 " * 70 + "서론") is None
    assert cleaning.section_of("") is None and cleaning.sectioned("") == []
    long = "가나다라마바사아자차카타파하 " * 3 + "결론"
    assert cleaning.section_of(long) == "conclusion" and cleaning.section_of(long * 2) is None


def test_identification(spark):
    d = spark.createDataFrame([("a", 1, "저작자표시-비영리-변경금지\n이용허락규약"), ("a", 2, "스마트공장 도입이 성과에\n미치는 영향 분석\n2020년 2월"), ("b", 1, ""), ("c", 1, None)], "id string, page int, t string")
    got = {r.id: r for r in identify.identified(d, "id", "page", "t").collect()}
    assert got["a"].title == "스마트공장 도입이 성과에 미치는 영향 분석" and got["a"].status == "AUTO_IDENTIFIED"
    assert got["b"].status == got["c"].status == "NEEDS_OCR_OR_REVIEW"


def test_best_match_against_brute_force(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(9, 26))) for _ in range(120)]
    mine = []
    for i, n in enumerate(names[:60]):
        m = list(n)
        for _ in range(rng.randint(0, 2)):
            m[rng.randrange(len(m))] = rng.choice("abcdefgh")
        mine.append((f"p{i:02d}", "".join(m)[: len(m) - rng.randint(0, 2)]))
    index = [(f"k{i:03d}", n, i) for i, n in enumerate(names + names[:5])]

    def sim(a, b):
        if a == b:
            return 1.0
        short, long = sorted((len(a), len(b)))
        if short >= 10 and (a in b or b in a):
            return short / long
        x, y = ({s[i : i + 2] for i in range(len(s) - 1)} for s in (a, b))
        return len(x & y) / len(x | y)

    want = {}
    for pid, t in mine:
        s, _, k = max((sim(t, u), -o, k) for k, u, o in index)
        if s >= 0.82:
            want[pid] = (k, round(s, 9))
    d = spark.createDataFrame(mine + [("x", None), ("y", "")], "id string, t string")
    got = dedupe.best_match(d, "id", "t", spark.createDataFrame(index, "k string, u string, o int"), "k", "u", "o")
    assert {r.id: (r.k, round(r.similarity, 9)) for r in got.collect()} == want and len(want) >= 30


def test_first_accepted_against_a_loop(spark):
    rng = random.Random(9)
    rows = [(i, f"k{rng.randrange(25)}", rng.choice(["", f"t{rng.randrange(25)}"])) for i in range(120)]
    keys, titles, want = set(), set(), []
    for i, k, t in rows:
        if t and k not in keys and t not in titles:
            keys.add(k)
            titles.add(t)
            want.append(i)
    d = spark.createDataFrame(rows, "_ord long, k string, t string")
    assert sorted(r._ord for r in dedupe.first_accepted(d, F.col("k"), F.col("t")).collect()) == want
    assert dedupe.first_accepted(d.limit(0), F.col("k"), F.col("t")).count() == 0


def test_exclusion_map_is_validated(spark):
    d = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    kept, gone = dedupe.excluded(d, spark.createDataFrame([("b", "a")], "duplicate_id string, kept_id string"), "id")
    assert {r.id for r in kept.collect()} == {"a", "c"} and [(r.id, r.kept_id) for r in gone.collect()] == [("b", "a")]
    with pytest.raises(ValueError):
        dedupe.excluded(d, spark.createDataFrame([("b", "z")], "duplicate_id string, kept_id string"), "id")


def test_records_in_both_formats():
    own = oai.parsed('<r:record xmlns:r="u"><r:header><r:identifier> i1 </r:identifier></r:header><r:metadata><oai_kci><articleInfo article-id="ART1"/><article-title>t0</article-title><article-title lang="english">te</article-title><name>A</name><name>a</name><pub-year>2001</pub-year><pub-year>2002</pub-year><url>ftp://x</url></oai_kci></r:metadata></r:record>')
    assert (own["identifier"], own["title"], own["title_en"], own["authors"], own["publication_year"], own["article_id"], own["landing_url"]) == ("i1", "t0", "te", ["A"], "2002", "ART1", None)
    dc = oai.parsed("<record><header status='deleted'/><metadata><dc><title>a</title><title>b</title><creator>X; Y|Z</creator><subject>s</subject><date>1999-01</date><url>http://k?artiId=ART22</url><description>see 10.1234/ab.</description></dc></metadata></record>")
    assert (dc["deleted"], dc["title"], dc["title_en"], dc["authors"], dc["category"], dc["publication_year"], dc["article_id"], dc["doi"]) == ("Y", "a", "b", ["X", "Y", "Z"], "s", "1999", "ART22", "10.1234/ab")
    assert oai.parsed("<broken")["metadata_type"] == "unknown"


def test_ingest_takes_all_pages(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    for i in range(6):
        (feed / f"{i:05d}.xmls").write_text(f"<r>{i}</r>\n")
    spark.dataSource.register(oai.PageFeed)
    stream = spark.readStream.format("quillmill_pages").option("path", str(feed)).option("maxPagesPerTrigger", 2).load()
    ingest(stream, str(tmp_path / "log"), str(tmp_path / "cp"))
    assert sorted(r.page for r in spark.read.parquet(str(tmp_path / "log")).collect()) == list(range(6))


def test_requests_are_repeated_but_not_protocol_errors():
    asked = []

    def ask():
        asked.append(1)
        if len(asked) < 3:
            raise OSError("no answer")
        return "page"

    assert harvest.patient(ask, 5, 0) == "page" and len(asked) == 3
    with pytest.raises(harvest.HarvestError):
        harvest.patient(lambda: harvest.answered(b"<OAI><error code='badArgument'>x</error></OAI>"), 5, 0)
    rows, token = harvest.records_of(harvest.answered(b"<OAI><record>1</record><resumptionToken> t </resumptionToken></OAI>"))
    assert len(rows) == 1 and token == "t"


def test_failed_rows_keep_their_error(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, t string")

    def plug(r):
        if r["t"] == "b":
            raise ValueError("bad")
        return {"n": 1}

    got = {r.id: (r.n, r.error) for r in files.enriched(d, plug, d.where("id = 3").select("id"), "id", "id int, n int", retries=2, wait=0).collect()}
    assert got[1] == (1, None) and got[2][0] is None and "bad" in got[2][1] and 3 not in got


@pytest.mark.parametrize("chars,found,ratio,want", [(999, 9, 1.0, "LOW_TEXT"), (2999, 9, 1.0, "VERY_SHORT"), (3000, 0, 1.0, "SECTION_FAILED"), (3000, 1, 1.0, "LOW_SECTION_DETECTION"), (3000, 2, 0.34, "REVIEW"), (3000, 2, 0.35, "OK")])
def test_quality(spark, chars, found, ratio, want):
    assert spark.range(1).select(lines.quality_status(F.lit(chars), F.lit(found), F.lit(ratio)).alias("s")).first().s == want


@pytest.mark.parametrize("raw,clean,part,want", [(4000, 1000, 900, "CRITICAL"), (4000, 2000, 1900, "WARNING"), (2000, 1900, 1900, "SOURCE_SHORT"), (4000, 3900, 3900, "OK"), (0, 0, 0, "CRITICAL")])
def test_preservation(spark, raw, clean, part, want):
    assert spark.range(1).select(audit.preservation(F.lit(raw), F.lit(clean), F.lit(part)).alias("s")).first().s == want


def test_extraction_risk(spark, tmp_path):
    p = spark.createDataFrame([("a", 4, 9000), ("b", 10, 3000), ("c", 10, 1500), ("d", 4, 9000)], "paper_id string, page_count int, text_chars int")
    body = lambda n: "가" * n
    s = spark.createDataFrame([("a", body(4000) + "\n머리" * 50), ("a", "머리\n" * 20 + "".join(f"- {i} -\n" for i in range(20))), ("b", body(6000)), ("c", body(1000)), ("d", body(4000)), ("d", None)], "paper_id string, content string")
    p.write.parquet(f"{tmp_path}/papers_verified.parquet")
    s.write.parquet(f"{tmp_path}/paper_sections.parquet")
    got = {r.paper_id: (r.signals, r.status) for r in catalog.queries()["extraction_risk"](spark, str(tmp_path)).collect()}
    assert got == {"a": ("REPEATED", "OK"), "b": ("LOW_RAW_PER_PAGE", "CHECK"), "c": ("VERY_LOW_TEXT|VERY_LOW_PER_PAGE|LOW_RAW_PER_PAGE|VERY_SHORT", "OCR_CANDIDATE"), "d": ("", "OK")}


def test_packing():
    rng = random.Random(3)
    for _ in range(200):
        sents = ["x" * rng.randint(1, 90) for _ in range(rng.randint(0, 60))]
        out = packed(sents, 50, 250, 350)
        assert all(50 <= len(s) <= 350 for s in out)
        assert len("".join(out).replace(" ", "")) <= len("".join(sents))
    assert packed(["y" * 40], 50, 250, 350) == []
    assert "".join(cut_long("ab " * 3000)).replace(" ", "") == "ab" * 3000
    assert max(map(len, cut_long("z" * 9999))) <= 3500


def test_splits(spark):
    got = dataset.shuffled_split([f"paper_{i:04d}" for i in range(181)])
    assert sum(v == "validation" for v in got.values()) == 27
    d = spark.range(20000).select(F.col("id").cast("string").alias("k")).select("k", dataset.hashed_split(F.col("k")).alias("s"))
    assert 0.13 < d.where("s = 'validation'").count() / 20000 < 0.17


def test_metadata(spark):
    base = spark.createDataFrame([("1", "", "a"), ("2", "t", None), ("3", None, None)], "id string, title string, doi string")
    hi = spark.createDataFrame([("1", "H", "b")], "id string, title string, doi string")
    ai = spark.createDataFrame([("1", "A", None), ("2", "A", "c")], "id string, title string, doi string")
    got = {r.id: (r.title, r.doi, r.merged_from) for r in metadata.precedence_merge(base, [("HIGH", hi), ("AI", ai)], "id", ["title", "doi"]).collect()}
    assert got == {"1": ("H", "a", "HIGH"), "2": ("t", "c", "AI"), "3": (None, None, "UNRESOLVED")}
    up = metadata.upsert(base, hi, "id")
    assert up.count() == 3 and up.where("id = '1'").first().title == "H"
    fixed = metadata.corrected(base, hi.select("id", "title"), "id", ["title"])
    assert {r.id: r.title for r in fixed.collect()} == {"1": "H", "2": "t", "3": None}


def test_json_sources(spark, tmp_path):
    p = str(tmp_path / "a")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2}\nnot json\n', encoding="utf-8")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert jsonl.read_jsonl(spark, p, schema, "drop").count() == 2
    assert [r._corrupt_record for r in jsonl.read_jsonl(spark, p, schema, "keep").collect() if r._corrupt_record] == ["not json"]
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, p, schema).collect()
    assert jsonl.read_jsonl(spark, p + "none", schema, missing="empty").count() == 0
    assert jsonl.line_errors(spark, p, schema).first().asDict() == {"scanned": 4, "blank": 1, "malformed": 1}
    d = spark.createDataFrame([(["x", "y"], 1)], "l array<string>, n int")
    jsonl.write_csv(d, str(tmp_path / "c"), ["n", "l"])
    assert jsonl.read_csv(spark, str(tmp_path / "c")).first().l == "x | y"
    main, review = jsonl.side_split(spark.createDataFrame([(1,), (None,)], "n int"), F.col("n") > 0)
    assert main.count() == 1 and review.count() == 1


def test_page_feed_resumes(spark, tmp_path):
    spark.dataSource.register(oai.PageFeed)
    pages = tmp_path / "pages"
    pages.mkdir()
    rec = "<record><header{}><identifier>{}</identifier></header><metadata><oai_kci><article-title lang=\"original\">제목</article-title></oai_kci></metadata></record>"
    (pages / "00000.xmls").write_text(json.dumps(rec.format("", "i1")) + "\n", encoding="utf-8")
    feed = lambda: spark.readStream.format("quillmill_pages").option("path", str(pages)).load()
    log, check = str(tmp_path / "log"), str(tmp_path / "check")
    ingest(feed(), log, check)
    (pages / "00001.xmls").write_text(json.dumps(rec.format(' status="deleted"', "i2")) + "\n", encoding="utf-8")
    ingest(feed(), log, check)
    got = oai.parse_records(compacted(spark, log, ["xml"], "page"))
    assert {(r.identifier, r.deleted) for r in got.collect()} == {("i1", "N"), ("i2", "Y")}


def test_binary_documents(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes("첫째\f".encode() + b"x" * 200)
    docs = files.documents(spark, str(tmp_path))
    pages = files.pages(docs)
    assert pages.count() == 2
    again = files.recovered(pages, lambda name, page: "recognised text")
    assert {(r.page, r.mode) for r in again.collect()} == {(1, "OCR"), (2, "DIRECT")}


def test_session(spark):
    d = spark.range(5)
    assert materialise(d).count() == 5
    assert broadcast_if_small(d, 2).count() == 5 and broadcast_if_small(d).count() == 5


def test_a_page_is_read_without_the_rest(spark, tmp_path):
    from quillmill.sources import harvest

    d = spark.range(20_000).select(F.concat(F.lit("2"), F.pmod("id", F.lit(2)).cast("string")).alias("datestamp"), F.concat(*[F.sha2(F.concat_ws("x", "id", F.lit(j)), 512) for j in range(24)]).alias("xml"))
    harvest.write_feed(harvest.paged(d, ["20", "21"], 100), str(tmp_path / "feed"))
    feed = harvest.FolderFeed(str(tmp_path / "feed"))
    assert feed.ranges() == ["20", "21"] and len(feed._index()) > 4
    got = []
    for within in feed.ranges():
        token = None
        while True:
            at = int(token or 0)
            hold = [g for g in feed._index() if g[0] <= within <= g[1] and g[2] <= at <= g[3]]
            assert sum(f.subset(row_group_ids=[g]).to_table(columns=["page"]).num_rows for *_, f, g in hold) < 20_000 / 4
            rows, token = feed.page(within, token)
            got += rows
            if token is None:
                break
    assert len(got) == len(set(got)) == 20_000


def test_best_match_of_a_title_that_repeats_itself(spark):
    """One title contains the other, but shares few of its distinct bigrams."""
    part = "ab" * 20 + "c"
    own = spark.createDataFrame([("p", part)], "paper_id string, t string")
    index = spark.createDataFrame([("k", part + "defghijkl", 1)], "article_id string, u string, _ord int")
    got = dedupe.best_match(own, "paper_id", "t", index, "article_id", "u", "_ord").collect()
    assert [(r.article_id, round(r.similarity, 2)) for r in got] == [("k", 0.82)]
