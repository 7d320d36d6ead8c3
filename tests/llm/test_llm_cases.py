"""Cases that once went wrong: shared ids, few labels, odd markup, executors without the package."""

import subprocess
import sys

from pyspark import cloudpickle

from episeries.llm import decontamination, html_extraction, toxicity
from episeries.llm.html_blocks import blocks_of

QUIZ = " ".join(f"quiz{i}" for i in range(12))


def test_rows_that_share_an_id_or_have_none_are_documents_of_their_own(spark):
    items = spark.createDataFrame([(1, QUIZ)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(None, f"a {QUIZ} b"), (None, "quite clean"), (7, QUIZ), (7, "clean too"), (7, "clean too"),
         (8, None), (8, "")],
        "doc_id long, text string")
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.contaminated)
                   for r in decontamination.contamination(docs, items).collect())
    assert found == [("7", 2, 0, 0, False)] * 2 + [("7", 12, 12, 1, True)] + [
        ("8", 0, 0, 0, False)] * 2 + [("None", 2, 0, 0, False), ("None", 14, 12, 1, True)]
    left = decontamination.keep(docs, items)
    assert left.columns == docs.columns
    assert sorted(map(str, (r.text for r in left.collect()))) == [
        "", "None", "clean too", "clean too", "quite clean"]


def test_few_labels_still_tell_texts_apart(spark):
    rows = [(i, ("you vile stinking wretch " if i % 16 == 0 else "a calm and friendly line ")
             + " ".join(f"w{i}x{j}" for j in range(8))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 16 == 0)) for i in range(80)],
                                   "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, labels).collect()}
    assert min(scores[i] for i in range(0, 80, 16)) > max(
        s for i, s in scores.items() if i % 16)


def texts(page):
    return [b.text for b in blocks_of(page)]


def test_odd_markup_takes_no_text_with_it():
    assert texts("<p>a <svg class=i /> b</p><p>c</p><svg><text>no</text></svg><p>d</p>") == [
        "a b", "c", "d"]
    assert texts("<p>a <svg class=i> b</p><p>c</p>") == ["a b", "c"]
    assert texts("<p>x <math><mi>y</mi></math> z</p><noscript><p>n</p></noscript>"
                 "<object>o</object><canvas>k</canvas>") == ["x y z", "n", "ok"]
    assert texts("<p>a</p><button>go</button><script>b</script>") == ["a", "go"]


def test_a_form_inside_the_article_is_not_main_text():
    labeller = html_extraction.Labeller()
    labeller.fit(html_extraction.training_pages(html_extraction.MADE_PAGES))
    words = "Some plain words of the story that go on for a while, as stories do. "
    page = (f"<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>A head</h1>"
            f"<p>{words * 2}</p><form action=/send><p>Your name</p><input><button>Send</button></form>"
            f"<p>{words * 3}</p></article><footer>&copy; us</footer></body></html>")
    wanted = "\n".join(["A head", (words * 2).strip(), (words * 3).strip()])
    assert html_extraction.texts([page], labeller) == [wanted]


def test_executors_need_no_copy_of_the_package(tmp_path):
    for name, function in {
        "html": html_extraction.extractor(html_extraction.Labeller()),
        "toxic": toxicity.parts("toxic"),
    }.items():
        (tmp_path / name).write_bytes(cloudpickle.dumps(function))
    program = (
        "import pickle, pandas as pd\n"
        "page = pd.DataFrame({'page_id': [1], 'url': ['u'], 'html': ['<p>a b</p>']})\n"
        "print(len(list(pickle.load(open('html', 'rb'))([page]))))\n"
        "text = pd.DataFrame({'text': ['a b'], 'toxic': [1]})\n"
        "print(len(list(pickle.load(open('toxic', 'rb'))([text]))))\n")
    run = subprocess.run([sys.executable, "-c", program], cwd=tmp_path, capture_output=True,
                         text=True, timeout=120, check=False)
    assert run.stdout.split() == ["1", "1"], run.stderr
