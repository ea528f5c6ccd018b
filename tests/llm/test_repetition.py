"""Repetition among clean documents, and small languages, in the quality rules."""

import numpy as np


def test_repetition_is_rejected(spark):
    from chronopix.llm.quality_rules import kept_documents, quality_rules

    rng = np.random.default_rng(3)
    text = lambda n: " ".join("w" * int(k) + str(i) for i, k in enumerate(rng.integers(2, 9, n)))
    menu = text(40) + "\nhome page\n" + "\n".join(["home page"] * 15)
    rows = [(i, text(60), "en", "web", 1) for i in range(80)]
    # a repeated line beside other words, so that no window of eight words occurs twice
    rows.append((90, "\n".join(f"next\nw{i}xxx yyy{i}" for i in range(30)), "en", "web", 1))
    rows.append((91, "\n".join(f"next\nw{i}xxx yyy{i}" for i in range(30)), "qq", "web", 1))
    rows.append((92, text(60), "qq", "web", 1))
    rows.append((93, menu, "en", "web", 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in quality_rules(df).collect()}
    assert [got[i].base_failed for i in (90, 91, 92)] == [False] * 3 and got[90].n_dup_lines == 29 and got[90].n_repeat_words == 0
    assert not got[90].kept and not got[91].kept and not got[93].kept
    assert got[92].kept and got[92].d2 is not None and sum(got[i].kept for i in range(80)) >= 78
    assert {r.doc_id for r in kept_documents(df).collect()} == {i for i, r in got.items() if r.kept}
