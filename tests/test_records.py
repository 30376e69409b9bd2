import base64
import json

from pyspark.sql import functions as F

from wordloom.functions.lexicon import POLARITY
from wordloom.functions import records
from wordloom.operators import documents, routing

F3 = "`" * 3


def parsed(spark, raws, fn, **options):
    rows = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    return fn(rows, **options).orderBy("i").collect()


def test_retrieval_replies(spark):
    good = json.dumps({"results": "- a", "metrics": {"num_retrieved": 2, "error_message": None}})
    rows = parsed(spark, [good, f"{F3}json\n{good}\n{F3}", f"{F3}{good}{F3}", "plain words", "[1]", '{"results": "x"}', '{"results": '], records.parse_retrieval)
    assert [(r.results, r.num_retrieved) for r in rows[:3]] == [("- a", 2)] * 3
    for r in (rows[3], rows[4], rows[6]):
        assert r.results == records.BAD_RETRIEVAL and r.num_retrieved == 0 and r.error_message.startswith("JSON decode error")
    assert (rows[5].results, rows[5].num_retrieved, rows[5].error_message) == ("x", 0, None)


def test_document_replies_and_report(spark):
    metrics = {"file_type": "DOCX", "file_size": 277362, "parse_time": 1.234, "parse_start": "p", "original_length": 15783, "cleaned_length": 8942, "error_message": None}
    raws = [json.dumps({"content": "- fine", "metrics": metrics}), "I could not do it", json.dumps({"content": "c", "metrics": {"file_size": "big", "error_message": "e"}})]
    rows = records.parse_documents(spark.createDataFrame(list(enumerate(raws)), "i int, raw string"))
    report = [r[0] for r in rows.orderBy("i").select(records.document_report(F.col("content"), F.col("metrics"), F.lit("then"))).collect()]
    for line in ("- Type: DOCX", "- Size: 270.86 KB", "1. Parsing Stage:", "   - Duration: 1.23s", "   - Started: p", "2. Cleaning Stage:", "   - Duration: N/A", "   - Started: N/A", "   - Content Reduction: 6841 characters", "No errors reported by agent."):
        assert line in report[0].split("\n")
    assert records.BAD_DOCUMENT in report[1] and "JSONDecodeError" in report[1]
    assert "- Size: Invalid Size Data" in report[2] and "### Errors during Processing\n- e" in report[2]
    images = [r[0] for r in rows.select(records.image_report(F.lit(""), F.col("metrics"), F.lit("then"))).collect()]
    assert all(i.endswith("No text extracted") for i in images)
    at = records.utc_text(F.lit("2025-05-27 07:00:00").cast("timestamp"))
    timed = rows.select(records.document_report(F.col("content"), F.col("metrics"), F.lit("then"), at)).first()[0]
    assert timed.endswith("- fine\n\n### Final Output\nGenerated at: 2025-05-27T07:00:00Z")


def test_numbers_round_by_their_exact_value(spark):
    values = [1.265, 1.615, 0.125, 2.675, 270.861328125, 1234.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(records.two_digits(F.col("v"))).collect()] == [f"{v:.2f}" for v in values]


def test_assignment_lists(spark):
    raws = ["[{'agent': 'A', 'path': 'p'}]", f'{F3}json\n[{{"agent": "A", "path": "p"}}]\n{F3}', "no list", '{"agent": "A"}']
    df = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    got = [r[0] for r in df.orderBy("i").select(records.parse_assignments(F.col("raw"))).collect()]
    assert [[tuple(x) for x in g] if g else g for g in got] == [[("A", "p")], [("A", "p")], None, None]


def test_images(spark):
    uri = "data:image/png;base64," + base64.b64encode(b"tiny").decode()
    rows = [("six", json.dumps([uri] * 6)), ("object", json.dumps({"a": uri, "b": uri})), ("bad", "[oops"), ("none", None)]
    table = spark.createDataFrame(rows, "app_name string, app_images string")
    asked = spark.createDataFrame([(n,) for n in ("six", "object", "bad", "none", "absent")], "app_name string")
    got = {r.app_name: (r.status, r.total_images, r.message) for r in records.image_envelopes(asked, table).collect()}
    ok = "Images Fetched Successfully"
    assert got == {"six": (True, 5, ok), "object": (True, 2, ok), "none": (True, 0, ok),
                   "bad": (False, 0, "Failed to parse app_images JSON"), "absent": (False, 0, "Images Not Found")}
    mime, size = records.image_payload(F.col("u"))
    df = spark.createDataFrame([(uri,), ("data:image/gif;base64,###",), ("data:image/png;base64,dGlu\r\neQ==",)], "u string")
    assert [tuple(r) for r in df.select(mime, size).collect()] == [("image/png", 4), ("image/gif", None), ("image/png", 4)]


def test_email_fields(spark):
    mail = "From: a@x\nTo: b@y\nsubject:  Hi there \n\nBody\n\nSubject: not this"
    row = spark.createDataFrame([(mail,), ("no headers",)], "m string").select(*[c.alias(n) for n, c in records.email_fields(F.col("m")).items()]).collect()
    assert tuple(row[0]) == ("b@y", "a@x", "Hi there", "Body\n\nSubject: not this")
    assert tuple(row[1]) == ("", "", "", "")


def agents(spark, path, images, *rules):
    df = spark.createDataFrame([(path, images)], "path string, has_images boolean")
    return sorted(r.agent for r in routing.route(df, *rules).collect())


def test_routing(spark):
    site = "https://host.example"
    first = {
        ("/a/b.pptx", True): ["File Parsing Agent", "Image Processing Agent"], ("/a/b.PDF", False): ["File Parsing Agent"],
        ("/a/b.eml", True): ["Email Agent"], ("/a/b.vtt", None): ["Transcript Agent"], ("/a/b.png", False): ["Image Processing Agent"],
        ("/a/b", True): ["File Parsing Agent"], ("/a/b.zip", True): ["File Parsing Agent"],
        (site + "/:b:/t/x?e=6.docx", False): ["File Parsing Agent", "Image Processing Agent", "SharePoint Agent"],
        (site + "/x.txt?y=1", False): ["SharePoint Agent", "Transcript Agent"],
    }
    for (path, images), want in first.items():
        assert agents(spark, path, images) == want, path
    second = (routing.RULES_WITH_MAIL_IMAGES, None)
    assert agents(spark, "/a/b.msg", True, *second) == ["Email Agent", "Image Processing Agent"]
    assert agents(spark, site + "/x", False, *second) == ["File Parsing Agent"]


def test_paths(spark):
    df = spark.createDataFrame([(p,) for p in ("/a//b/./c/", "/a/../../b", "x/../y/..", "../a/b/..", "/")], "p string")
    assert [r[0] for r in df.select(documents.normal_path(F.col("p"))).collect()] == ["/a/b/c", "/b", ".", "../a", "/"]
    types = spark.createDataFrame([(p,) for p in ("/x.d/file", "/x/a.tar.gz", "b.Pdf")], "p string")
    assert [r[0] for r in types.select(documents.file_type(F.col("p"))).collect()] == ["", "GZ", "PDF"]
    guard = spark.createDataFrame([("/a/b", "/a/./b"), ("/a/b", "/a/c"), ("/a/b", None)], "expected string, actual string")
    assert [r.error is None for r in documents.path_guard(guard).collect()] == [True, False, False]


def test_resolve_paths(spark):
    manifest = spark.createDataFrame([("/p/assets/x.txt",), ("/abs/y",), ("/p/assets/z",)], "full_path string")
    names = ["assets/x.txt", "/abs/y", "x.txt", "gone/z", "missing", " ", "{{ a }}", None, "/abs/z"]
    req = spark.createDataFrame(list(enumerate(names)), "request_id bigint, file_name string")
    got = [(r.path, r.status) for r in documents.resolve_paths(req, manifest, "/p", "/p/assets").orderBy("request_id").collect()]
    assert got == [("/p/assets/x.txt", "found"), ("/abs/y", "found"), ("/p/assets/x.txt", "found"), ("/p/assets/z", "fallback"),
                   (None, "not found"), (None, "invalid"), (None, "invalid"), (None, "invalid"), ("/p/assets/z", "fallback")]


def test_elements(spark):
    html = "<html><head><style>p{}</style><title>T &amp; t</title></head><body><script>if (a<b) x='</p>'</script><h1>Head</h1><p>one <b>bold</b><br/>two</p><!-- <p>no</p> --><div> </div></body>"
    row = spark.range(1).select(documents.page_elements(F.lit(html)), documents.text_elements(F.lit("a\n\n  b\nc \n \n"))).first()
    assert row[0] == ["T & t", "Head", "one bold", "two"] and row[1] == ["a", "b\nc"]


def test_annotations(spark):
    rows = [
        (1, 0, 0, 2, "Acme Corp", "ORG"), (1, 1, 1, 3, "Corp disk", "NOUN_CHUNK"), (1, 3, 3, 5, "Full Disk", "NOUN_CHUNK"), (1, 9, 9, 10, "DATE", "DATE"),
        (2, 0, 0, 1, "a", "NOUN_CHUNK"), (2, 1, 1, 2, "b", "NOUN_CHUNK"), (3, 0, 0, 1, "a", "NOUN_CHUNK"), (3, 1, 1, 2, "b", "NOUN_CHUNK"),
        (3, 2, 2, 3, "c", "NOUN_CHUNK"), (4, 0, 0, 1, "Acme", "ORG"),
    ]
    notes = spark.createDataFrame(rows, "doc_id bigint, pos int, start int, end int, text string, type string")
    text = spark.createDataFrame([(1, "x" * 20), (2, "x" * 20), (3, "x" * 20), (4, " " + "x" * 19), (5, None)], "doc_id bigint, description string")
    got = {r.doc_id: tuple(r)[1:] for r in documents.annotation_sufficiency(text, notes).collect()}
    assert got == {1: (True, 1, 1, "acme corp, full disk"), 2: (False, 0, 2, "a, b"), 3: (True, 0, 3, "a, b, c"), 4: (False, 0, 0, ""), 5: (False, 0, 0, "")}


def test_sentiment_and_sections(spark):
    tokens = spark.createDataFrame([(1, ["good", "good", "bad"]), (2, ["bad"]), (3, ["x"]), (4, [])], "i int, tokens array<string>")
    lexicon = spark.createDataFrame([("good", 1), ("bad", -1)], "term string, polarity int")
    assert {r.i: r.label for r in documents.sentiment_labels(tokens, lexicon, ["i"]).collect()} == {1: "positive", 2: "negative", 3: "neutral", 4: "neutral"}
    template = spark.createDataFrame([("a", 1, "# A"), ("b", 2, "# B")], "section string, pos bigint, heading string")
    one = spark.createDataFrame([("a", "s1", 2, "two"), ("a", "s1", 1, "one"), ("zz", "s1", 1, "elsewhere")], "section string, source string, item bigint, text string")
    two = spark.createDataFrame([("a", "s0", 9, "zero")], "section string, source string, item bigint, text string")
    lines = documents.compose_sections(template, [one, two]).orderBy(F.asc_nulls_last("pos"), "part", "source", "item").collect()
    assert [(r.pos, r.line) for r in lines] == [(1, "# A"), (1, "zero"), (1, "one"), (1, "two"), (2, "# B"), (None, "elsewhere")]


def test_only_one_whole_json_object_is_a_reply(spark):
    good = json.dumps({"results": "a", "metrics": {"num_retrieved": 1}})
    bad = [good + " That is all.", good + good, f"{good}, {good}", good.replace('"', "'"), "", "{}x"]
    assert all(r.results == records.BAD_RETRIEVAL for r in parsed(spark, bad, records.parse_retrieval))
    assert all(r.content == records.BAD_DOCUMENT for r in parsed(spark, bad, records.parse_documents))


def test_an_odd_field_does_not_spoil_the_record(spark):
    rows = parsed(spark, [json.dumps({"results": "kept", "metrics": {"num_retrieved": "two", "error_message": "e"}}), json.dumps({"results": 7})], records.parse_retrieval)
    assert [(r.results, r.num_retrieved, r.error_message) for r in rows] == [("kept", 0, "e"), ("7", 0, None)]


def test_a_size_sent_as_text_is_no_size(spark):
    raws = [json.dumps({"content": 'says "file_size": "9"', "metrics": {"file_size": size}}) for size in (277362, "277362", None)]
    rows = records.parse_documents(spark.createDataFrame(list(enumerate(raws)), "i int, raw string")).orderBy("i")
    report = [r[0] for r in rows.select(records.document_report(F.col("content"), F.col("metrics"), F.lit("then"))).collect()]
    for text, want in zip(report, ("270.86 KB", "Invalid Size Data", "N/A")):
        assert f"- Size: {want}" in text.split("\n")


def test_annotations_of_one_long_document(spark):
    """Both window frames only grow; a frame that shrank would take minutes here."""
    n = 60_000
    df = spark.range(n).select(
        F.lit(1).alias("doc_id"), F.col("id").alias("pos"), F.col("id").alias("start"), (F.col("id") + 1).alias("end"),
        F.lit("w").alias("text"), F.when(F.col("id") % 3 == 0, "ORG").otherwise("NOUN_CHUNK").alias("type"),
    )
    assert documents.merge_annotations(df).count() == n


def test_default_polarity_words(spark):
    assert len({word for word, _ in POLARITY}) == len(POLARITY)
    rows = [(1, "thanks this is excellent".split()), (2, "the upload failed again".split()), (3, "good but slow".split()), (4, ["the", "of"])]
    lexicon = spark.createDataFrame(list(POLARITY), "term string, polarity int")
    got = documents.sentiment_labels(spark.createDataFrame(rows, "i int, tokens array<string>"), lexicon, ["i"]).collect()
    assert {r.i: r.label for r in got} == {1: "positive", 2: "negative", 3: "neutral", 4: "neutral"}


def test_descriptions_stay_out_of_the_join_with_annotations(spark):
    """Only whether a description is long enough is joined, and labels are ordered without a comparator per pair."""
    notes = spark.createDataFrame(
        [(1, p, p, p + 1, f"T{9 - p % 10}", "ORG") for p in (11, 2, 7, 1)] + [(2, 0, 0, 1, "b", "NOUN_CHUNK")],
        "doc_id bigint, pos int, start int, end int, text string, type string",
    )
    text = spark.createDataFrame([(1, "x" * 20), (1, "x"), (2, "x" * 20), (None, "x" * 20)], "doc_id bigint, description string")
    made = documents.annotation_sufficiency(text, notes)
    got = sorted((r.doc_id or 0, r.n_entities, r.n_chunks, r.keywords) for r in made.collect())
    assert got == [(0, 0, 0, ""), (1, 0, 0, ""), (1, 4, 0, "t8, t7, t2, t8"), (2, 0, 1, "b")]
    plan = made._jdf.queryExecution().optimizedPlan()
    join = next(p for p in (plan.p(i) for i in range(20)) if p is not None and p.nodeName() == "Join")
    assert "description" not in join.output().mkString() and "array_sort" not in plan.toString()
