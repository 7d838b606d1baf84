"""Lines that many documents of a host share: counted by distinct documents."""

from __future__ import annotations

from lamina.llm import quality_rules

NOTICE = "we use cookies on this site to measure visits and to show offers that may interest all of our readers everywhere"
DISCLAIMER = "nothing on this page is advice and the publisher takes no liability at all for what its readers do with it afterwards"


def kept_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return {r.doc_id: r.text for r in quality_rules.keep(docs, max_docs=10, max_share=0.1).collect()}


def test_two_shared_lines_longer_than_the_own_ones_count_in_full(spark):
    rows = [(i, f"{NOTICE}\nown {i}\n{DISCLAIMER}", "h") for i in range(40)]
    rows += [(100 + i, f"{NOTICE}\n{DISCLAIMER}\n" + " ".join(f"w{i}x{j}" for j in range(60)), "h") for i in range(3)]
    assert set(kept_of(spark, rows)) == {100, 101, 102}


def test_exact_copies_count_once_and_so_do_the_documents_of_the_host(spark):
    rows = [(i, f"{NOTICE}\n{DISCLAIMER}", "h") for i in range(400)] + [(1000 + i, f"{NOTICE}\nown {i}", "h") for i in range(12)]
    assert set(kept_of(spark, rows)) == set(range(400))


def test_kept_texts_go_on_without_the_removed_lines(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(i, f"  {NOTICE.upper()} \n\n{own(i)}\n{own(i)[::-1]}", "h") for i in range(40)] + [(100, f"{NOTICE}\n{own(100)}", None)]
    assert kept_of(spark, rows) == {i: f"\n{own(i)}\n{own(i)[::-1]}" for i in range(40)} | {100: rows[-1][1]}
