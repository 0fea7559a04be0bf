import re

from tapewright.llm import line_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(docs, least=50):
    """Line numbers to delete: every run of worded lines is compared with every earlier one."""
    lines = {i: [(n, l) for n, l in enumerate((t or "").split("\n")) if WORD.search(l)] for i, t in docs.items()}
    seen, gone = {}, {i: set() for i in docs}
    for i in sorted(docs):
        own = lines[i]
        for a in range(len(own)):
            words = 0
            for b in range(a, len(own)):
                words += len(WORD.findall(own[b][1]))
                if words >= least:
                    run = tuple(l for _, l in own[a:b + 1])
                    seen.setdefault(run, (i, a))
                    j, first = seen[run]
                    if (j, first) != (i, a):
                        start = max(a, first + b - a + 1) if j == i else a
                        gone[i] |= {n for n, _ in own[start:b + 1]}
                    # Longer runs are unions of windows: stop where both borders are tight.
                    if sum(len(WORD.findall(l)) for _, l in own[a:b]) >= least:
                        break
        for b in range(len(own)):
            words = 0
            for a in range(b, -1, -1):
                words += len(WORD.findall(own[a][1]))
                if words >= least:
                    run = tuple(l for _, l in own[a:b + 1])
                    seen.setdefault(run, (i, a))
                    j, first = seen[run]
                    if (j, first) != (i, a):
                        start = max(a, first + b - a + 1) if j == i else a
                        gone[i] |= {n for n, _ in own[start:b + 1]}
                    break
    return gone


def test_matches_brute_force(frame, corpus):
    docs = {i: t for i, t in enumerate(corpus)}
    rows = {r["doc_id"]: r for r in line_dedup.report(frame(corpus)).collect()}
    expected = brute(docs)
    assert rows.keys() == docs.keys()
    for i, t in docs.items():
        assert set(rows[i]["removed"]) == expected[i], i
        if t is None:
            assert rows[i]["text"] is None
        else:
            kept = [l for n, l in enumerate(t.split("\n")) if n not in expected[i]]
            assert rows[i]["text"] == "\n".join(kept)
    assert sum(map(bool, expected.values())) > 50


def test_first_occurrence_and_other_columns_stay(frame):
    run = " ".join(f"p{i}" for i in range(60))
    out = line_dedup.clean(frame([f"a\n{run}", f"{run}\nb", run, None, ""]))
    rows = {r["doc_id"]: r["text"] for r in out.collect()}
    assert rows == {0: f"a\n{run}", 1: "b", 3: None, 4: ""}
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_repeated_rows_null_ids_clashing_columns_and_empty_table(spark, frame):
    run = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(None, run, 1, "x"), (5, run, 2, "y"), (5, run, 3, "z"), (6, "c", 4, "w")],
                                 "doc_id long, text string, lines int, removed string")
    rows = line_dedup.clean(docs).collect()
    assert sorted((r["lines"], r["removed"]) for r in rows) == [(1, "x"), (4, "w")]
    assert line_dedup.report(frame([])).count() == 0
