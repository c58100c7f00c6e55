import re
from collections import Counter

import pytest

from wordloom.llm.quality_rules import quality_rules



def prose(n, mark="x"):
    """Sentences of words that never repeat."""
    return "".join(" ".join(f"{mark}{k}word{j}" for j in range(12)) + ". " for k in range(n))


TEXTS = [
    None,
    "",
    " \n\t ",
    "short text.",
    prose(8),
    "\n".join(prose(1, f"l{k}") for k in range(8)) + "\nHome | About | Contact | Login\nAll rights reserved.",
    "\n".join("Home | About | Contact | Login | Page%d | More%d" % (k, k) for k in range(20)),
    "\n".join("BUY!! NOW%d!! THIS!! OFFER%d!!" % (k, k) for k in range(30)),
    "\n".join("wor%d### and*** a%d%%%%%% b&&&" % (k, k) for k in range(30)),
    "same words again and " * 30,
    "one line.\none line.\n\n\none line.\n" + prose(8),
    "a b a b a b a b " + " ".join(f"w{k}" for k in range(60)) + ".",
    "x " * 20000,
    "\x1cword part next.\n" * 3 + prose(6),
]


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {k + j for k in range(len(words) - 2) if runs[tuple(words[k : k + 3])] > 1 for j in range(3)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


@pytest.fixture(scope="module")
def judged(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").repartition(3)
    return {r.doc_id: r for r in quality_rules(docs).collect()}


def test_base_columns(judged):
    for k, text in enumerate(TEXTS):
        r = judged[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(text), text


def test_verdicts(judged):
    assert {k for k, r in judged.items() if r.kept} == {4, 5, 10, 11, 13}


def test_only_failing_lines_go(judged):
    assert judged[5].clean_text == "\n".join(prose(1, f"l{k}") for k in range(8))
    assert judged[4].clean_text == TEXTS[4]
    assert judged[0].clean_text is None


def test_rows_that_repeat_and_clashing_columns(spark):
    rows = [(1, TEXTS[4], "a", 1), (1, TEXTS[4], "b", 2), (None, TEXTS[4], "c", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, words string, left bigint")
    made = quality_rules(docs).collect()
    assert [r.kept for r in made] == [True] * 3 and sorted(map(str, (r.doc_id for r in made))) == ["1", "1", "None"]


def test_empty_table(spark):
    assert quality_rules(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    plan = quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


CLEAN = [
    "Il a dit « oui » puis « non » hier.",
    "Er sagte »ja« und dann »nein« zu ihr.",
    "La col·laboració paral·lela va bé.",
    "The regulator said on Monday that the firm's privacy policy, written years ago, broke the law, and that a new plant powered by gas must wait.",
    "यह एक वाक्य है।",
    "یہ ایک جملہ ہے۔",
    "这是一个句子。那是另一个",
    "ประโยคภาษาไทยนี้ยาวมากและไม่มีเครื่องหมายวรรคตอน",
]
LAYOUT = ["Home » News » Sport.", "Start · Kontakt · Impressum.", "« Back | Home | Next »", "Read our privacy policy.", "Click here. Read more. Share this.", "मुख्य पृष्ठ"]


def test_prose_passes_and_layout_fails(spark):
    from pyspark.sql import functions as F

    from wordloom.llm.quality_rules import line_fails

    lines = spark.createDataFrame([(x,) for x in CLEAN + LAYOUT], "line string")
    failed = {r.line for r in lines.where(line_fails(F.col("line"))).collect()}
    assert failed == set(LAYOUT)


def test_equals_its_sql_twin_on_lines_of_all_kinds(spark):
    """Each line in a document of its own beside lines that pass, and documents of only such lines."""
    import duckdb

    from tests.compare import difference
    from wordloom.llm.oracles import ORACLES

    more = [
        "A long line that quotes “one” · and goes on | with a bar, but it is prose for the most part, as it says much more than a menu would.",
        "a·b·c·d e·f | g · h | i.", "‹ one › two ‹ three › four.", "»ja« | »nein« | vielleicht.", "privacy policy " * 9 + ".", "!!a!! b.", "#### x.", "###" + "x" * 60 + ".",
        "see 1·2·3 and · 4 · 5.", "ກ" * 25, "ก" * 19, "powered by " + "steam and other things " * 6 + ".", "x | y.", "x > y > z.", "Ende;", "Ende;nicht", "a… b", "؟", "\x1c",
    ]
    lines = CLEAN + LAYOUT + more
    texts = TEXTS + [prose(4, f"p{k}") + "\n" + "\n".join([line + f" {j}" if line in CLEAN else line for j in range(4)]) for k, line in enumerate(lines)]
    texts += [prose(5) + "\n" + (line + " ") * 12 for line in lines] + ["\n".join(lines) + prose(3), "\n".join(CLEAN * 12), "\n".join(more * 3)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    made = quality_rules(docs).drop("clean_text").toPandas()
    assert difference(made, connection.execute(ORACLES["op4_quality_rules"]).df()) == ""
    assert 0 < made.kept.sum() < len(made)


def test_a_clean_document_of_another_script_is_kept(spark):
    text = "\n".join(" ".join(f"शब्द{k}क{j}" for j in range(12)) + "।" for k in range(8))
    made = quality_rules(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert made.kept and made.clean_text == text
