import re

from tapewright.llm import surrogates

TEXTS = ["write to Ann.Lee@mail.example.com or ann.lee@mail.example.com, host 10.20.30.40.",
         "call +1 (743) 555-3824 or +1 (743) 555-3825; card 4785380592391139, 4785 3805 9239 1139",
         "Mr. John Smith met Mrs Anna Weber. Mr. John Smith left. г-н Иван Петров", "no data 12 here", "", None,
         "ann.lee@mail.example.com", "ssn 123-45-6789 and 123-45-6789", "v1.2.3.4.5 and 999.1.1.1",
         "x" * 60_000 + " bob@site.org " + "y " * 30_000]


def rows(frame, texts, **kw):
    return {r["doc_id"]: r for r in surrogates.replace(frame(texts), **kw).collect()}


def test_surrogates(frame):
    out = rows(frame, TEXTS)
    assert len(out) == len(TEXTS)
    for i in (3, 4, 5, 8):
        assert out[i]["text"] == TEXTS[i] and out[i]["entities"] == []
    first = re.findall(r"\S+@\S+[a-z]", out[0]["text"])
    assert first[0].lower() == first[1].lower() == out[6]["text"].lower() and "ann.lee" not in out[0]["text"].lower()
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{3}@[a-z]{4}\.[a-z]{7}\.com", out[6]["text"])
    assert re.search(r"host \d+\.\d+\.\d+\.\d+\.$", out[0]["text"]) and "10.20.30.40" not in out[0]["text"]
    phones = re.findall(r"\+\d \(\d{3}\) \d{3}-\d{4}", out[1]["text"])
    cards = re.findall(r"card (\d{16}), (\d{4} \d{4} \d{4} \d{4})$", out[1]["text"])[0]
    assert len(set(phones)) == 2 and cards[0] == cards[1].replace(" ", "") != "4785380592391139"
    digits = [int(c) for c in reversed(cards[0])]
    assert sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0
    m = re.fullmatch(r"Mr\. (\w+ \w+) met Mrs (\w+ \w+)\. Mr\. (\w+ \w+) left\. г-н (\w+ \w+)", out[2]["text"])
    assert m[1] == m[3] != m[2] and m[1].split()[0] in surrogates.GIVEN["m"]["latin"]
    assert m[2].split()[0] in surrogates.GIVEN["f"]["latin"] and m[4].split()[0] in surrogates.GIVEN["m"]["cyrillic"]
    assert out[2]["entities"] == ["person_m", "person_f", "person_m", "person_m"]
    assert "123-45-6789" not in out[7]["text"] and len(set(re.findall(r"[\d-]{11}", out[7]["text"]))) == 1
    assert out[9]["text"].startswith("x" * 60_000) and out[9]["text"].endswith("y " * 30_000) and "bob@" not in out[9]["text"]
    assert rows(frame, TEXTS, key="other")[6]["text"] != out[6]["text"]


def test_collisions_are_redrawn(spark):
    # 900 one-letter users of one domain letter: few free surrogates, many collisions.
    names = [(f"email", f"{a}{b}@q.org") for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqr"]
    out = surrogates.mapping(spark.createDataFrame(names, "kind string, norm string"), "k").collect()
    new = [r["new"] for r in out]
    assert len(out) == len(names) == len(set(new)) and not set(new) & {n for _, n in names}


def test_repeated_rows_clashing_columns_and_empty(spark, frame):
    docs = spark.createDataFrame([(None, "a@b.org", "old", 1), (5, "a@b.org", "old", 2), (5, "a@b.org", "old", 3)],
                                 "doc_id long, text string, entities string, kind int")
    out = surrogates.replace(docs).collect()
    assert len({r["text"] for r in out}) == 1 and sorted(r["kind"] for r in out) == [1, 2, 3]
    assert all(r["entities"] == ["email"] for r in out)
    assert surrogates.replace(frame([])).count() == 0


def test_one_word_names_stay_distinct_and_agree_with_full_ones(frame):
    def word(k):
        return "Q" + "".join(chr(97 + k // 26 ** e % 26) for e in range(3))
    # The first free draws are real surnames as well, so the form that is written has to give way.
    taken = ["".join(s).capitalize() for s in zip(["ba", "den", "fo", "gar"] * 9, ["hel", "ka", "lin"] * 12, ["mor", "ne"] * 18)]
    names = [word(k) for k in range(3000)] + sorted(set(taken))
    texts = [f"Mr {n} left" for n in names] + [f"Mrs {n} left" for n in names[:500]]
    texts += [f"Mr. John {n} and Mr Paul {n} left" for n in names[:100]] + [f"Mr {word(k)} {names[0]} left" for k in range(60)]
    out = [rows_["text"] for _, rows_ in sorted(rows(frame, texts).items())]
    short = [t.split(" ")[1] for t in out[:len(names) + 500]]
    assert len(set(short)) == len(short) and not set(short) & set(names)
    full = [re.fullmatch(r"Mr\. (\w+) (\w+) and Mr (\w+) (\w+) left", t).groups() for t in out[len(names) + 500:][:100]]
    for k, (a, b, c, d) in enumerate(full):
        assert b == d == short[k] and a != c
    others = [t.split(" ")[1:3] for t in out[-60:]]
    assert {last for _, last in others} == {short[0]} and len({first for first, _ in others} | {full[0][0], full[0][2]}) == 62


def test_long_runs_and_many_labels_are_linear(frame):
    labels = "a@" + "b." * 20_000 + "com"
    texts = [f"see {labels} here", "x" * 1_000_000, "a." * 500_000, "-._" * 300_000, "x" * 500_000 + "@", labels]
    out = rows(frame, texts)
    assert [out[i]["text"] for i in range(1, 5)] == texts[1:5]
    assert out[0]["entities"] == out[5]["entities"] == ["email"] and out[0]["text"] == f"see {out[5]['text']} here"
    assert re.fullmatch(r"[a-z]@(?:[a-z]\.){20000}com", out[5]["text"]) and out[5]["text"] != labels


def test_marks_before_an_address_stay(frame):
    out = rows(frame, ["to ..bob@site.org, bob@site.org%ann@site.org", "bob@site.org"])
    new = out[1]["text"]
    assert re.fullmatch(rf"to \.\.{re.escape(new)}, {re.escape(new)}%[a-z]{{3}}@[a-z]{{4}}\.org", out[0]["text"])
    assert out[0]["entities"] == ["email"] * 3


def test_short_addresses_get_distinct_surrogates(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    norms = [f"{a}@{b}.co" for a in letters for b in letters]  # every form of their length is a real address
    out = surrogates.mapping(spark.createDataFrame([("email", n) for n in norms], "kind string, norm string"), "k").collect()
    assert len(out) == len({r["new"] for r in out}) == len(norms) and not {r["new"] for r in out} & set(norms)
