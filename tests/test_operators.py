"""Facts about the operators on small literal rows."""

import pytest
from pyspark.sql import functions as F

from sparkloom.config import Settings
from sparkloom.functions import text as tx
from sparkloom.functions import tokens as tk
from sparkloom.operators import chunking, dedup, judge, quality, splits, topics
from sparkloom.plans import oracle


def one(spark, column, *values):
    row = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(column(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


def test_text(spark):
    assert one(spark, tx.collapse_space, " a\r\nb \t c\n\n\n\nd \n") == "a\nb c\n\nd"
    assert one(spark, tx.collapse_space, None) == ""
    assert one(spark, tx.signature, " What IS  café-bar? ") == "what is cafébar"
    assert one(spark, tx.repair_encoding, "aâ€“b c\x01") == "a–b c"
    assert one(spark, tx.clean_generated, "the <b>risk</b> high-\n frequency riskadjusted") == "The risk high-frequency risk-adjusted"
    assert one(spark, lambda c: tx.truncate(c, 20), "One two three. Four five six.") == "One two three."
    assert one(spark, tx.paper_voice, "We show that x") == "The paper shows that x"
    assert one(spark, tx.clean_markup, "Long body text here and more of it.\nReferences\nA paper") == "Long body text here and more of it."
    assert one(spark, tx.fold, "ÀÉîõü") == one(spark, tx.fold_all, "ÀÉîõü") == "aeiou"


def test_tokens(spark):
    assert one(spark, lambda c: tk.keywords(c, 2), "beta alpha beta gamma alpha what") == ["beta", "alpha"]
    assert one(spark, tk.keywords, "") == []
    assert one(spark, tk.sentences, "First one. Second two! and more? No end") == ["First one.", "Second two! and more?"]
    assert one(spark, tk.sentences, "0 is first. 1 is second! 2nd? 33 (3)") == ["0 is first.", "1 is second!", "2nd?", "33 (3)"]
    rows = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0, 5.0]), ([0.0], [1.0])], "a array<double>, b array<double>")
    assert [round(r[0], 3) for r in rows.select(tk.cosine(F.col("a"), F.col("b"))).collect()] == [round(1 / 26**0.5, 3), 0.0]


def test_chunks_end_at_words(spark):
    docs = spark.createDataFrame([(1, "alpha " * 100), (2, "short"), (3, None)], "doc_id long, text string")
    rows = chunking.chunk_documents(docs, 182, 30).collect()
    assert rows and all(r.text.endswith("alpha") and len(r.text) <= 182 for r in rows)
    assert {r.document for r in rows} == {"1"} and rows[0].chunk_id == "1-chunk-0000"


def test_headings_and_names(spark):
    text = "Definition and purpose\nKernel\nthis line is an ordinary sentence of the text.\nhttps://x.org\nProgram execution\nKERNEL"
    assert one(spark, topics.headings, text) == ["Definition and purpose", "Kernel", "Program execution"]
    names = ["1 Introduction", "Kernel", "abc", "Short", "Two words", "a / b / c / d"]
    assert [one(spark, topics.valid_name, n) for n in names] == [True, True, False, False, True, False]


SOURCE = "The kernel schedules processes and manages the memory of the whole machine for all of its users."


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({}, None),
        ({"context_source": SOURCE + " [a-chunk-0001]"}, "cross_chunk_context"),
        ({"answer": "It is shown in Figure 3 that <br> matters for scheduling processes"}, "artifact_or_reference_noise"),
        ({"context_source": SOURCE[4:]}, "truncated_context_source"),
        ({"answer": "We schedule processes and manage machine memory"}, "first_person_answer"),
        ({"answer": SOURCE}, "verbatim_answer"),
        ({"answer": "Bananas ripen quickly under tropical sunshine during summer"}, "insufficient_context_support"),
        ({"answer": "The kernel"}, "circular_answer"),
        ({"context_source_verified": False}, "unverified_context_source"),
    ],
)
def test_gate(spark, changes, reason):
    item = {"question": "What does the kernel do?", "answer": "It schedules processes, manages memory, users machine", "type": "factual", "context_source": SOURCE, "context_source_verified": True} | changes
    rows = spark.createDataFrame([tuple(item.values())], "question string, answer string, type string, context_source string, context_source_verified boolean")
    assert quality.quality_gate(rows).first()["rejection_reason"] == reason
    assert quality.quality_gate(rows, "off").first()["rejection_reason"] is None


@pytest.mark.parametrize("answer", ["Ouré une enè", "We-based", "our", "Oure", "Wełna", "Weekly"])
def test_first_person_reads_edges_of_words_as_its_sql(spark, answer):
    duckdb = pytest.importorskip("duckdb")
    rule = oracle.rules()["first_person_answer"].replace("coalesce(answer, '')", "?")
    want = duckdb.connect().execute(f"SELECT {rule}", [answer]).fetchall()[0][0]
    assert one(spark, quality.first_person, answer) == want


def test_deduplication_keeps_the_first_and_is_ordered(spark):
    rows = [
        (1, "What does the central kernel schedule first?", "Processes wait inside several queues until dispatch"),
        (2, "What does the central kernel schedule first", "Something else entirely different here"),
        (3, "Which memory pages are evicted under pressure?", "Least recently touched pages leave before others"),
        (4, "", "blank"),
    ]
    got = dedup.deduplicate_items(spark.createDataFrame(rows, "seq long, question string, answer string")).collect()
    assert {r.seq: r.duplicate_reason for r in got} == {1: None, 2: "duplicate_exact", 3: None, 4: "duplicate_exact"}


def test_equal_sets_are_compared_as_one(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK", 7)
    words = ["kernel", "memory", "pages", "queue", "thread", "socket", "driver", "cache"]
    answers = ["Processes wait inside several queues until dispatch.", "processes wait inside several queues until dispatch", "Until dispatch processes wait inside several queues", "short"]
    rows = [(i, f"{words[i % 8]} {words[i // 8]} asked{i // 3} number{i}", answers[i % 4]) for i in range(60)] + [(60, "", answers[0]), (61, None, None)]
    items = spark.createDataFrame(rows, "seq long, question string, answer string")
    sets = dedup.with_sets(items).cache()
    links, groups = dedup.similar_links(sets)
    assert links.where("place = 6").isEmpty() and groups.where("place = 6").count() == 61
    held = {r.seq: r for r in sets.collect()}
    near = lambda a, b, least: bool(a and b) and len(set(a) & set(b)) / min(len(a), len(b)) >= least

    def place(x, y):
        if x.question_signature and x.question_signature == y.question_signature:
            return 1
        if len(x.answer_signature) >= 12 and x.answer_signature == y.answer_signature:
            return 2
        return next((i for i, (c, least, _) in enumerate(dedup.MEASURES, 3) if near(x[c], y[c], least)), None)

    want = {(i, j): place(held[i], held[j]) for i in held for j in held if i < j}
    got = dedup.duplicate_links(items).collect()
    assert len(got) > 400 and {(r.earlier, r.later): r.place for r in got} == {k: v for k, v in want.items() if v} and len(got) == len({(r.earlier, r.later) for r in got})
    pairs = [tuple(r) for r in dedup.similar_pairs(sets, "answer_terms", 0.78).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {k for k in want if near(held[k[0]].answer_terms, held[k[1]].answer_terms, 0.78)}


def test_split_covers_topics(spark):
    rows = [(f"i{n}", f"t{t}") for t, k in enumerate((5, 4, 3)) for n in range(t * 10, t * 10 + k)]
    out = splits.split_rows(spark.createDataFrame(rows, "id string, topic_id string"), "0.7,0.15,0.15").collect()
    assert sorted(r.id for r in out) == sorted(i for i, _ in rows)
    assert [sum(r.split == s for r in out) for s in ("train", "val", "test")] == [8, 1, 3]
    assert len({r.topic_id for r in out if r.split == "test"}) == 3


def test_judge_limits(spark):
    def judged(reply):
        items = spark.createDataFrame([("x", "y", reply)], "answer string, context_source string, reply string")
        return judge.judge_items(items, F.col("reply")).first()

    low = judged('{"context_quality": 0.9, "answer_support": "0.55", "question_quality": 0.9, "overall_score": 0.9, "decision": "pass", "reasons": ["factual"]}')
    assert low.judge_decision == "fail" and low.judge_score <= 0.39
    blocked = judged('{"context_quality": 0.9, "answer_support": 0.9, "question_quality": 0.9, "overall_score": 0.9, "decision": "pass", "reasons": ["hallucinated"]}')
    assert blocked.judge_decision == "fail" and blocked.judge_score <= 0.35
    assert judged("no json").judge_decision == "review"


def test_settings():
    assert Settings().validated()
    with pytest.raises(ValueError, match="overlap"):
        Settings(chunk_size=100, chunk_overlap=100).validated()
