"""Fragments of contexts, models, generation, the judge, files and a whole run with models that need no server."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from sparkloom import cli, prompts
from sparkloom.config import Settings
from sparkloom.operators import context, dedup, generation, judge, splits, topics
from sparkloom.plans import pipeline, run
from sparkloom.sources import files, models, sinks
from sparkloom.streaming import incremental


def one(spark, column, *values):
    row = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(column(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


def test_sources_are_verified_word_for_word(spark):
    whole = "[doc-chunk-0001] Introduction text.  The kernel schedules processes and manages memory. It also handles files."
    got = one(spark, context.verified_source, "schedules processes", whole)
    assert (got.text, got.verified) == ("The kernel schedules processes and manages memory.", True)
    got = one(spark, context.verified_source, "SCHEDULES  processes", whole.replace("schedules processes", "schedules\tprocesses"))
    assert got.verified
    for source in ("schedules all processes", "", " "):
        got = one(spark, context.verified_source, source, whole)
        assert (got.text, got.verified) == ("", False)
    long = "Start. " + "word " * 300 + "end. Next one."
    got = one(spark, context.verified_source, "word " * 200, long)
    assert got.verified and got.text.startswith("word word") and got.text.endswith(("word", "end."))


def test_fragments_know_their_chunks(spark):
    whole = "[doc-chunk-0001] First chunk content. [doc-chunk-0002] Second chunk with risk metrics here."
    ids = lambda fragment: one(spark, lambda c, f: context.fragment_chunks(c, f), whole, fragment)
    assert ids("First chunk content. [doc-chunk-0002] Second chunk") == ["doc-chunk-0001", "doc-chunk-0002"]
    assert ids("risk metrics") == ["doc-chunk-0002"]
    assert ids("not there") == ids("") == ["doc-chunk-0001"]
    assert one(spark, lambda c, f: context.fragment_chunks(c, f), "no markers at all", "markers") == []


def test_excerpts_are_anchored(spark):
    whole = "[doc-chunk-0001] " + "Alpha words. " * 60 + "\n\n[doc-chunk-0002] " + "Beta words here. " * 40 + "The anchor sentence stands deep. " + "Gamma. " * 90
    take = lambda fragment, n=500: one(spark, lambda c, f: context.anchored_excerpt(c, f, n), whole, fragment)
    got = take("The anchor sentence stands deep.")
    assert got.startswith("[doc-chunk-0002] ... ") and "The anchor sentence stands deep." in got and len(got) <= 500
    assert take("Alpha words.").startswith("[doc-chunk-0001] Alpha words.")
    assert take("nowhere").startswith("[doc-chunk-0001] Alpha") and len(take("nowhere", 100)) <= 100 and not take("nowhere", 100).endswith("Alph")
    assert one(spark, lambda c, f: context.anchored_excerpt(c, f), "", "x") == ""
    compact = one(spark, lambda c: context.compact_context(c, 1700), whole)
    assert "[doc-chunk-0001]" in compact and "[doc-chunk-0002]" in compact and len(compact) <= 1700
    assert one(spark, lambda c: context.compact_context(c, 10_000), whole) == whole


def test_replies_are_read_in_many_forms(spark):
    rows = [
        ("a", 'Here it is: {"topics": [{"name": "Kernel", "summary": "s", "keywords": "one, two, One"}, {"title": "kernel"}, "A plain topic", {"x": 1}]}'),
        ("b", '{"temas": [{"tema": "Memoria virtual", "resumen": "r", "palabras_clave": ["x", "y"]}]}'),
        ("c", '{"other": [{"name": "From another key"}]}'),
        ("d", '{"Virtual memory": {"summary": "pages"}, "Scheduling": "a text long enough", "short": "x"}'),
        ("e", "no json"),
        ("f", 'lost { oops } and {"name": "Rescued", "summary": "s"}'),
        ("g", None),
    ]
    got = generation.topics_from_reply(spark.createDataFrame(rows, "document string, reply string")).orderBy("document", "topic_index").collect()
    found = [(r.document, r.topic_id, r.name, r.summary, r.keywords) for r in got]
    assert found == [
        ("a", "topic-00", "Kernel", "s", ["one", "two"]),
        ("a", "topic-02", "A plain topic", "A plain topic", ["plain", "topic"]),
        ("b", "topic-00", "Memoria virtual", "r", ["x", "y"]),
        ("c", "topic-00", "From another key", "From another key", ["another"]),
        ("d", "topic-00", "Virtual memory", "pages", ["virtual", "memory", "pages"]),
        ("d", "topic-01", "Scheduling", "a text long enough", ["scheduling", "text", "long", "enough"]),
        ("f", "topic-00", "Rescued", "s", ["rescued"]),
    ]
    assert [json.loads(one(spark, generation.json_object, t)) for t in ('{"a": 1}', 'x {"a": {"b": 2}} y', "nothing")] == [{"a": 1}, {"a": {"b": 2}}, {"items": []}]
    forms = ['{"items": [5, {"question": "q1"}]}', '{"items": {"question": "q2"}}', '{"items": "x", "preguntas": [{"question": "q3"}]}', '{"questions": [{"question": "no"}]}', '{"items": null, "item": {"question": "q4"}}']
    df = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i int, t string").select("i", F.try_variant_get(generation.raw_item(F.col("t")), "$.question", "string").alias("q"))
    assert {r.i: r.q for r in df.collect()} == {0: "q1", 1: "q2", 2: "q3", 3: None, 4: "q4"}


SENTENCES = ["The kernel schedules processes and allocates memory fairly for every active program.", "Pagination avoids fragmentation by dividing memory into fixed size pages for allocation."]


def evidence_of(spark, sentences=SENTENCES, **more):
    rows = [("doc", "topic-00", 0, more.get("topic", "Kernel scheduling"), "s", ["kernel", "memory"], f"e{i}", "doc-chunk-0000", i + 1, s, True, "English (en)", "en") for i, s in enumerate(sentences)]
    schema = "document string, topic_id string, topic_index int, topic string, topic_summary string, topic_keywords array<string>, evidence_id string, chunk_id string, evidence_rank int, evidence string, literal boolean, language string, document_language string"
    contexts = spark.createDataFrame([("doc", "topic-00", "[doc-chunk-0000] " + " ".join(sentences))], "document string, topic_id string, context string")
    return spark.createDataFrame(rows, schema), contexts


def mending(request):
    """Copies the passage first, and says it in other words when told off."""
    kernel = "kernel" in request["evidence"]
    answer = request["evidence"] if not request["feedback"] else "It schedules processes and manages memory." if kernel else "It divides memory into fixed size pages to avoid fragmentation."
    question = "What does the kernel do for active programs?" if kernel else "How are pages used?"
    return json.dumps({"items": [{"question": question, "answer": answer, "type": "factual", "difficulty": "EASY", "context_source": "invented"}]})


def test_rejected_answers_are_repaired_and_no_window_is_asked_in_vain(spark):
    got = generation.generate_items(*evidence_of(spark), mending, wanted=1)
    items = got.items.collect()
    assert [(r.id, r.context_source, r.context_source_verified, r.difficulty, r.source_chunk_ids) for r in items] == [("doc-topic-00-qa-00", SENTENCES[0], True, "easy", ["doc-chunk-0000"])]
    assert items[0].context_excerpt.startswith("[doc-chunk-0000] The kernel") and items[0].created_at.endswith("+00:00")
    assert got.stats == {"candidate_windows": 2, "attempted_windows": 1, "accepted_from_evidence": 1, "repair_attempts": 1, "discarded_windows": 0, "evidence_exhausted_topics": 0}
    known = spark.createDataFrame([("doc", "what does the kernel do for active programs")], "document string, question string")
    again = generation.generate_items(*evidence_of(spark), mending, wanted=1, existing=known, offset=6)
    assert [r.id for r in again.items.collect()] == ["doc-topic-00-qa-06"]
    reasons = {(r.evidence_id, r.attempt): r.reason for r in again.attempts.collect()}
    assert reasons == {("e0", 1): "duplicate_existing_question", ("e0", 2): "duplicate_existing_question", ("e0", 3): "duplicate_existing_question", ("e1", 1): "verbatim_answer", ("e1", 2): None}


def test_seed_questions_are_not_rephrased(spark):
    evidence, contexts = evidence_of(spark, SENTENCES[1:], topic="How does pagination avoid fragmentation?")
    reply = json.dumps({"items": [{"question": "rephrased", "answer": "It divides memory into fixed size pages to avoid fragmentation.", "type": "odd"}]})
    seen = []
    got = generation.generate_items(evidence, contexts, lambda r: reply, wanted=1, seed_mode=True).items.collect()
    assert [(r.question, r.type, r.difficulty) for r in got] == [("How does pagination avoid fragmentation?", "factual", "medium")]
    empty = generation.generate_items(evidence.limit(0), contexts, lambda r: seen.append(r) or reply, wanted=1)
    assert empty.items.count() == 0 and empty.stats["attempted_windows"] == 0


def test_calls_are_retried_but_not_refused_ones():
    calls = []

    def failing(kind):
        def model(request):
            calls.append(kind)
            raise kind("x")

        return model

    assert models.ask(failing(ValueError), {}, 3, 0) == models.NOTHING and len(calls) == 3
    assert models.ask(failing(models.Refused), {}, 3, 0) == models.NOTHING and len(calls) == 4
    listing = {"models": [{"model": "gemma:4b"}, {"name": "other"}]}
    models.check_model(lambda: listing, "gemma")
    models.check_model(lambda: type("L", (), {"models": [type("E", (), {"model": "a:b"})()]})(), "a:latest")
    with pytest.raises(RuntimeError, match="gemma"):
        models.check_model(lambda: listing, "absent")
    with pytest.raises(RuntimeError, match="does not answer"):
        models.check_model(failing(OSError), "gemma")


def test_server_speaks_json():
    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            seen.append((self.path, json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            code, body = (400, {}) if seen[-1][1]["model"] == "bad" else (200, {"message": {"content": "{}"}} if self.path == "/api/chat" else {"embedding": [1, 2]})
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def do_GET(self):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b'{"models": [{"name": "m:1"}]}')

        def log_message(self, *args):
            pass

    http = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=http.serve_forever, daemon=True).start()
    server = models.Server(f"http://127.0.0.1:{http.server_port}/", "m")
    assert server({"messages": [{"role": "user", "content": "x"}], "temperature": 0.3, "seed": 5}) == "{}"
    assert seen[0][1]["options"] == {"temperature": 0.3, "seed": 5} and seen[0][1]["format"] == "json"
    assert server.embed("text") == [1.0, 2.0]
    models.check_model(server.listing, "m")
    with pytest.raises(models.Refused):
        models.Server(server.url, "bad")({"messages": []})
    http.shutdown()


def test_prompts_hold_what_they_are_given():
    request = {"document": "D", "topic": "T", "topic_summary": "S", "topic_keywords": ["k"], "evidence": "E", "language": "Catalan", "existing": ["asked?"], "feedback": "mend", "wanted": 3, "context": "C", "question": "Q", "answer": "A", "context_source": "CS", "topic_id": "hidden"}
    for prompt, held in ((prompts.topic_map, ["D", "C", "3", "Catalan"]), (prompts.topic_map_of_excerpts, ["C", "3"]), (prompts.item, ["T", "S", "k", "E", "asked?", "mend"]), (prompts.seed_answer, ["T", "E", "mend"]), (prompts.judgement, ["Q", "A", "CS"])):
        told = prompt(request)
        assert [m["role"] for m in told] == ["system", "user"] and all(h in told[1]["content"] for h in held)
    assert "hidden" not in prompts.judgement(request)[1]["content"]
    questions = [f"q{i}" for i in range(100)]
    some = prompts.sampled_questions(questions, 20)
    assert len(some) == 20 and some[-10:] == questions[-10:] and some == prompts.sampled_questions(questions, 20) and prompts.sampled_questions(questions[:5], 20) == questions[:5]


def test_vectors_are_cached(spark, tmp_path):
    rows = spark.createDataFrame([("c1", "one"), ("c2", "two"), ("c3", "fails")], "chunk_id string, text string")
    log = tmp_path / "calls"

    def embedder(text):
        with open(log, "a") as f:
            f.write(text + "\n")
        if text == "fails":
            raise OSError
        return [float(len(text)), 1.0]

    for _ in range(2):
        got = {r.chunk_id: r.vector for r in models.embedded(rows, embedder, "chunk_id", "text", "m", str(tmp_path / "cache")).collect()}
        assert got == {"c1": [3.0, 1.0], "c2": [3.0, 1.0], "c3": []}
    assert sorted(log.read_text().split()) == ["fails", "fails", "one", "two"]


def test_judge_goes_by_document(spark):
    seeds = []
    items = [(f"i{n}", f"d{n % 2}", n, "What is it?", "A fresh answer in words", "The kernel schedules processes and manages memory for users.") for n in range(4)]
    items.append(("i9", "d0", 9, "Q", "â€™ broken", "source"))
    df = spark.createDataFrame(items, "id string, document string, seq long, question string, answer string, context_source string")

    def judge_model(request):
        return json.dumps({"context_quality": 1, "answer_support": "1.0", "question_quality": 1, "overall_score": request["seed"] / 100, "decision": "pass", "reasons": ["factual"]})

    got = {r.id: r for r in judge.judge_by_document(df, judge_model, "m", seed=80).collect()}
    assert [got[f"i{n}"].judge_score for n in range(4)] == [0.8, 0.8, 0.81, 0.81] and got["i9"].judge_model == "m:precheck" and not seeds
    bad = judge.judge_by_document(df.where("id = 'i0'"), lambda r: "no json", "m").first()
    assert (bad.judge_decision, bad.judge_reasons, bad.judge_score) == ("review", ["judge_error"], 0.0)
    told = {r.id: r.rejection_reason for r in judge.judge_filter(judge.judge_by_document(df, judge_model, "m", seed=80)).collect()}
    assert told["i0"] is None and told["i9"] == "judge_fail:extraction_artifact"


def plain_dedup(rows):
    """The greedy choice row by row."""
    import re

    from sparkloom.lexicon import STOPWORDS

    sign = lambda t: re.sub(r"[^\w\s]", "", re.sub(r"\s+", " ", t.strip().lower()))
    words = lambda t: [w for w in re.findall(r"[a-z]{4,}", t.lower()) if w not in STOPWORDS]
    pairs = lambda w: set(w) if len(w) < 2 else set(zip(w, w[1:], strict=False))
    near = lambda a, b, t: bool(a) and bool(b) and len(a & b) / min(len(a), len(b)) >= t
    kept, out = [], {}
    for seq, q, a in sorted(rows):
        s, t = sign(q), sign(a)
        sets = (pairs(words(q)), set(words(q)), set(words(f"{q} {a}")), set(words(a)))
        if not s or any(s == k[0] for k in kept):
            out[seq] = "duplicate_exact"
        elif len(t) >= 12 and any(t == k[1] for k in kept):
            out[seq] = "duplicate_semantic_answer"
        else:
            checks = ((0.78, "duplicate_semantic_question"), (0.75, "duplicate_semantic_question"), (0.80, "duplicate_semantic_qa"), (0.78, "duplicate_semantic_answer"))
            out[seq] = next((r for i, (least, r) in enumerate(checks) if any(near(sets[i], k[2][i], least) for k in kept)), None)
        if out[seq] is None:
            kept.append((s, t, sets))
    return out


def test_deduplication_equals_a_plain_walk(spark):
    import random

    rng = random.Random(1)
    vocabulary = ["kernel", "memory", "pages", "disk", "queue", "signal", "thread", "cache", "driver", "mount"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows = [(i, text(rng.randint(2, 7)) + "?", text(rng.randint(1, 8))) for i in range(120)]
    rows += [(200 + i, rows[i % 5][1], rows[i % 5][2]) for i in range(30)] + [(300 + i, rows[3][1], text(6)) for i in range(20)] + [(400, "", "x"), (401, "?!", "y")]
    got = dedup.deduplicate_items(spark.createDataFrame(rows, "seq long, question string, answer string"))
    want = plain_dedup(rows)
    assert {r.seq: r.duplicate_reason for r in got.collect()} == want
    counts = {r.reason: r["items"] for r in dedup.duplicate_counts(got).collect()}
    assert counts == {k: sum(v == k for v in want.values()) for k in set(want.values()) if k}


def test_splits_and_audit(spark):
    rows = spark.createDataFrame([(f"i{n}", "d", f"t{n % 3}") for n in range(20)], "id string, document string, topic_id string")
    plain = splits.split_rows(rows.drop("topic_id"), "0.5,0.25,0.25")
    assert {r.split: r["count"] for r in plain.groupBy("split").count().collect()} == {"train": 10, "val": 5, "test": 5}
    expected = spark.createDataFrame([("d", "t0"), ("d", "t9"), ("e", "t0")], "document string, topic_id string")
    audit = splits.dataset_audit(splits.split_rows(rows), rows.limit(1), expected)
    assert audit["topics_without_accepted"] == ["d::t9", "e::t0"] and audit["topics"] == 5 and audit["coverage_ratio"] == 0.6 and not audit["pipeline_success"]


def test_files(spark, tmp_path):
    (tmp_path / "topics.yaml").write_text("topics:\n  - name: Kernel design\n    keywords: [a, b]\n  - summary: none\n  - name: Paging\n    summary: of memory\n")
    (tmp_path / "topics.txt").write_text("# no\nKernel design\n\n Paging tables \n")
    (tmp_path / "empty.txt").write_text("# only\n\n")
    (tmp_path / "questions.txt").write_text("What is a page?\n# x\nWhy?\n")
    got = files.topics_file(spark, str(tmp_path / "topics.yaml")).orderBy("topic_index").collect()
    assert [(r.topic_id, r.name, r.summary, r.keywords) for r in got] == [("user-00", "Kernel design", "Kernel design", ["a", "b"]), ("user-02", "Paging", "of memory", ["paging"])]
    assert [r.topic_id for r in files.topics_file(spark, str(tmp_path / "topics.txt")).orderBy("topic_index").collect()] == ["user-00", "user-01"]
    for read in (files.topics_file, files.questions_file):
        with pytest.raises(ValueError):
            read(spark, str(tmp_path / "empty.txt"))
    seeds = topics.question_topics(files.questions_file(spark, str(tmp_path / "questions.txt"))).orderBy("topic_index").collect()
    assert [(r.topic_id, r.name) for r in seeds] == [("seed-00", "What is a page?"), ("seed-01", "Why?")]
    (tmp_path / "pdf").mkdir()
    for name in ("b.PDF", "a.pdf", "c.txt"):
        (tmp_path / "pdf" / name).write_bytes(b"text of " + name.encode())
    found = files.pdf_files(spark, str(tmp_path / "pdf"))
    assert [r.name for r in found.collect()] == ["a.pdf", "b.PDF"]
    assert [r.name for r in files.only_documents(found, "B, a.pdf").collect()] == ["b.PDF", "a.pdf"] and files.only_documents(found, None).count() == 2
    with pytest.raises(ValueError, match="zzz"):
        files.only_documents(found, "a,zzz")
    with pytest.raises(FileNotFoundError):
        files.pdf_files(spark, str(tmp_path / "absent"))
    assert {r.document: r.raw_text for r in files.extracted(found, lambda b: b.decode() + " <br> |x|").collect()}["a.pdf"] == "text of a.pdf x"
    (tmp_path / "items").mkdir()
    (tmp_path / "items" / "x.json").write_text('{"id": "1", "document": "a", "topic_id": "t", "source_chunk_ids": ["c1", "c2"]}\nbroken\n{"id": "2", "document": "a", "topic_id": "u", "source_chunk_ids": ["c2"]}\n')
    items = files.checkpoint_items(spark, str(tmp_path / "items"))
    assert items.count() == 2 and files.checkpoint_items(spark, str(tmp_path / "none")).count() == 0
    counts = lambda *a: tuple(files.resume_counts(items, *a).first())[1:]
    assert counts() == (2, 2)
    assert counts(spark.createDataFrame([("a", 9, 5)], "document string, chunk_count long, topic_count long")) == (9, 5)
    assert counts(spark.createDataFrame([("a", 0, 0)], "document string, chunk_count long, topic_count long"), spark.createDataFrame([("a",)] * 4, "document string")) == (4, 2)


def test_cleaning_keeps_to_its_folders(tmp_path):
    for at in ("output/deep/a.json", "output/.gitkeep", "output/b.txt", "run_logs/x/c.jsonl", "run_logs/x/_SUCCESS", "other/d.json"):
        (tmp_path / at).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / at).write_text("x")
    roots = [str(tmp_path / "output"), str(tmp_path / "run_logs")]
    assert sinks.clean_outputs(roots, str(tmp_path), dry_run=True) == {"files": 2, "dirs": 0}
    assert sinks.clean_outputs(roots, str(tmp_path)) == {"files": 2, "dirs": 2}
    assert (tmp_path / "output/.gitkeep").exists() and (tmp_path / "output/b.txt").exists() and (tmp_path / "other/d.json").exists()
    with pytest.raises(ValueError):
        sinks.clean_outputs([str(tmp_path / "other")], str(tmp_path))


def test_settings_from_flags_and_environment():
    settings, _ = cli.settings_of(["--judge", "filter", "--output", "output/x.jsonl", "--num-topics", "3"], {"DATASET_CHUNK_SIZE": "900", "OLLAMA_DATASET_MODEL": "m"})
    assert (settings.judge, settings.output, settings.topics, settings.chunk_size, settings.model, settings.judge_model, settings.retrieval) == ("filter", "output/x", 3, 900, "m", "m", "hybrid")
    assert Settings(topics_file="a", questions_file="b", embedding_model=" ", judge="audit", judge_model="").errors()
    with pytest.raises(ValueError, match="no file"):
        Settings(topics_file="absent").validated(lambda p: False)
    assert cli.main(["--chunk-overlap", "9999"]) == 1


def test_new_documents_are_chunked_once(spark, tmp_path):
    schema = "doc_id long, text string"
    for i in range(2):
        spark.createDataFrame([(i, "alpha beta " * 60)], schema).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.stream_chunks(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "checkpoint"), 400, 50).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).select("document").distinct().count() == i + 1


THEMES = ("Virtual memory", "Process scheduling", "File systems")


def paper(k):
    parts = []
    for n, theme in enumerate(THEMES):
        low = theme.lower()
        parts.append(f"{theme}\n" + " ".join(f"The {low} unit number {i} of machine {k} keeps {w} records about {low} safely for each running program." for i, w in enumerate(("seven", "eight", "nine", "ten", "eleven", "twelve"))))
    return "\n\n".join(parts) + "\nReferences\nA paper about nothing."


def writer(request):
    """Maps topics from headings, judges well, and asks about the evidence in words of its own."""
    if "context" in request and "wanted" in request and "evidence" not in request:
        return "not json" if "machine 1 " in request["context"] else json.dumps({"topics": [{"name": t, "summary": f"About {t}", "keywords": t.lower().split()} for t in THEMES]})
    if "evidence" not in request:
        return json.dumps({"context_quality": 0.9, "answer_support": 0.9, "question_quality": 0.9, "overall_score": 0.9 if "seven" not in request["answer"] else 0.2, "reasons": ["factual"] if "seven" not in request["answer"] else ["hallucination"]})
    words = [w.strip(".") for w in request["evidence"].split()]
    picked = " ".join(words[2::3])
    return json.dumps({"items": [{"question": f"Which facts does passage {request['evidence_id']} hold on {request['topic']}?", "answer": f"About {request['topic'].lower()}: {picked}", "type": "inference"}]})


def letters(text):
    low = text.lower()
    return [float(low.count(c)) for c in "abcdefghijklmnop"]


def test_a_whole_run_and_its_resumption(spark, tmp_path):
    docs = spark.createDataFrame([(f"p{k}.pdf", f"p{k}", paper(k)) for k in range(2)] + [("empty.pdf", "empty", None)], "document string, document_stem string, raw_text string")
    settings = Settings(output=str(tmp_path / "out" / "set"), debug=str(tmp_path / "logs"), chunk_size=700, chunk_overlap=80, topics=3, questions_per_topic=2, judge="filter", retries=1)
    meta = run.run(spark, docs, run.Models(writer, letters), settings)
    read = lambda name: spark.read.json(str(tmp_path / "out" / name))
    rows = read("set.jsonl")
    assert meta["document_count"] == 3 and meta["accepted_items"] == rows.count() > 0
    assert sum(meta["split"].values()) == rows.count() and meta["split"] == {s: read(f"set_{s}.jsonl").count() for s in ("train", "val", "test") if meta["split"][s]} | {s: 0 for s in ("train", "val", "test") if not meta["split"][s]}
    assert read("set.judged.jsonl").count() == meta["judge"]["judged_items"] == meta["deduplicated_items"]
    assert meta["rejected_items"] == (read("set.rejected.jsonl").count() if meta["rejected_items"] else 0)
    first = rows.first()
    for name in ("id", "question", "answer", "type", "difficulty", "context_source", "context_source_verified", "topic", "topic_id", "topic_keywords", "document", "document_language", "source_chunk_ids", "created_at", "context_excerpt"):
        assert first[name] not in (None, "", [])
    assert json.loads((tmp_path / "out" / "set.meta.json").read_text())["quality"]["evidence_first"]["attempted_windows"] > 0
    debug = {r.document: r for r in spark.read.json(str(tmp_path / "logs" / "documents")).collect()}
    assert debug["p0.pdf"].topic_map_strategy == "llm" and debug["p1.pdf"].topic_map_strategy == "fallback_section_headings"
    assert meta["document_languages"] == {"p0.pdf": "en", "p1.pdf": "en", "empty.pdf": "en"}

    def silent(request):
        raise AssertionError("a document that is done is not asked for again")

    again = run.run(spark, docs.where("document <> 'empty.pdf'"), run.Models(silent, letters), Settings(**{**settings.__dict__, "resume": True, "judge": "off", "output": str(tmp_path / "out" / "again")}))
    assert again["resumed_documents"] == 2 and again["quality"]["evidence_first"]["attempted_windows"] == 0 and again["accepted_items"] >= meta["accepted_items"]


def test_contexts_widen_and_semantic_retrieval_prefers_the_nearest(spark):
    docs = pipeline.documents_of(spark.createDataFrame([("d", "d", paper(0))], "document string, document_stem string, raw_text string"), Settings())
    chunks = pipeline.chunking.chunk_documents(docs, 400, 40, None, "document", "raw_text", counted=True)
    rows = spark.createDataFrame([("d", "topic-00", 0, "Nothing of it", "", ["rarelex"]), ("d", "topic-01", 1, "No vector", "", ["scheduling"])], "document string, topic_id string, topic_index int, name string, summary string, keywords array<string>")
    nearest = chunks.agg(F.max("chunk_id")).first()[0]
    of_chunks = chunks.select("chunk_id", F.when(F.col("chunk_id") == nearest, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0))).alias("chunk_vector"))
    of_topics = spark.createDataFrame([("d", "topic-00", [1.0, 0.0]), ("d", "topic-01", [])], "document string, topic_id string, topic_vector array<double>")
    for how in ("semantic", "hybrid"):
        got = pipeline.contexts_of(pipeline.scored_chunks(chunks, rows, how, (of_chunks, of_topics)), chunks, docs).where("rank = 1")
        first = {r.topic_id: r for r in got.collect()}
        assert first["topic-00"].chunk_id == nearest and "scheduling" in first["topic-01"].text.lower()
    wide = pipeline.contexts_of(pipeline.scored_chunks(chunks, rows), chunks, docs, Settings(gate="balanced", context_budget=600))
    assert {(r.chunk_id, len(r.text) <= 600) for r in wide.collect()} == {(None, True)}
    evidence = pipeline.evidence_rows(wide, rows).where("usable").collect()
    assert evidence and {r.chunk_id for r in evidence} == {None} and any(r.literal for r in evidence)  # a window over a line end does not stand there word for word
