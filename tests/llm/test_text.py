"""Truncation, look-alikes, scan noise and languages on small cases."""

import json

import pytest

from folioframe.llm import languages, lookalikes, scannoise, truncation

LONG = "The old rope held the green door beside the wide market near the river"


# truncation -----------------------------------------------------------------------------------------------------------------


def replies(spark, *texts):
    return spark.createDataFrame([(i, t, "m", "x") for i, t in enumerate(texts, 1)], "result_id long, raw_text string, model string, id string")


def test_cut_replies(spark):
    full = [LONG + "."] * 6 + ["A registration found the old university of the wide market."] * 6
    whole = json.dumps({"pages": [{"block_text": full, "block_classes": ["Text"] * 12}]})
    texts = {
        whole: False,
        "```json\n" + whole + "\n```": False,
        whole[: len(whole) // 2]: True,
        "```json\n" + whole[:90] + "\n```": True,
        whole.replace('": [', '" [', 1): False,  # malformed but whole
        json.dumps({"pages": [{"block_text": [LONG + " and the old univ"]}]}): True,
        json.dumps({"pages": [{"block_text": ["Old Market of Zzyx"]}]}): False,  # a title
        LONG + ". " + LONG + ".": False,
        LONG + ". " + LONG + " behind the old regis": True,
        LONG + ".\n— 14 —": False,
        LONG + ".\n(remaining text unreadable)": False,
        LONG + ". ...": False,
        LONG + ".\nThe old…[cut]": True,
        None: False,
        "": False,
        " \n": False,
    }
    rows = replies(spark, *texts)
    found = {r.id for r in truncation.truncated(rows.union(rows)).collect()}
    assert found == {i for i, cut in enumerate(texts.values(), 1) if cut}
    rate = truncation.rates(rows.union(rows), "result_id", "raw_text", ["model"]).first()
    assert (rate.n_replies, rate.n_truncated) == (len(texts), sum(texts.values()))


def test_rules_that_decide(spark):
    full = [LONG + "."] * 6 + ["A registration found the old university of the wide market."] * 6
    whole = json.dumps({"pages": [{"block_text": full, "block_classes": ["Text"] * 12}], "order": [0, 1, 2, 3]})
    texts = [whole, whole[:90], whole[: whole.index("wide market") + 11], whole[: whole.index(", 2")], LONG + ". " + LONG, LONG + " behind the old regis"]
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts, 1)], "id long, raw_text string, weight string")
    assert {tuple(r) for r in truncation.rules(rows, "id").collect()} == {(2, "words"), (3, "marks"), (4, "pieces"), (5, "marks"), (6, "words")}


def test_no_replies(spark):
    assert truncation.truncated(replies(spark, None).limit(0)).count() == 0


# look-alikes ----------------------------------------------------------------------------------------------------------------


def texts(spark, *rows):
    return spark.createDataFrame([("block", i, t, "x") for i, t in rows], "src string, id long, text string, form string")


def test_forms_and_pairs(spark):
    base = "Rope, café 12\n\tआदमी"
    same = ["Ｒope, café 12\n\tआदमी", "Rope, café 1​2\n\tआदमी", "Rоpe, café 12\n\tअादमी"]
    other = ["rope, café 12\n\tआदमी", "Rope, cafe 12\n\tआदमी", "Rope café 12\n\tआदमी", "Rope,  café 12\n\tआदमी", "Rope, café ¹²\n\tआदमी"]
    rows = [(k, t) for k, t in enumerate([base, *same, *other], 1)] + [(20, None), (21, ""), (22, ""), (1, base), (30, base)]
    pairs = {tuple(r)[1:] for r in lookalikes.lookalike_pairs(texts(spark, *rows)).collect()}
    group = [1, 2, 3, 4, 30]
    assert pairs == {(a, b) for a in group for b in group if a < b} - {(1, 30)}
    classes = {(r.id, r.class_id, r.n_spellings, r.n_alike) for r in lookalikes.groups(texts(spark, *rows)).collect()}
    assert classes == {(1, 1, 4, 3), (30, 1, 4, 3), (2, 1, 4, 4), (3, 1, 4, 4), (4, 1, 4, 4)}
    out = {r.id: r.form for r in lookalikes.forms(texts(spark, *rows)).collect()}
    assert out[2] == out[1] == base and out[20] is None and out[21] == ""
    assert lookalikes.lookalike_pairs(texts(spark, (1, "x")).limit(0)).count() == 0


def test_presentation_forms_are_by_rule():
    one, plain, several = lookalikes.compatibility_forms()
    table = dict(zip(one, plain)) | dict(several)
    assert table["Ａ"] == "A" and table["ﬁ"] == "fi" and "²" not in table


# scan noise -----------------------------------------------------------------------------------------------------------------

PAGES = "page_id long, file string, page_no int, full_text string, loaded_at string"
BLOCKS = "block_id long, page_id long, idx int, text string, class_label string, line string"


def noise(spark, pages, blocks=()):
    p = spark.createDataFrame([(i, "f", n, t, "") for i, n, t in pages], PAGES)
    b = spark.createDataFrame([(*b, "x") for b in blocks], BLOCKS)
    return {tuple(r) for r in scannoise.noise(p, b).collect()}, p, b


def test_noise_by_kind(spark):
    body = "The documentation of the well-preserved market was found\nbeside the documentation of the market."
    pages = [(k, k, f"Registry of Markets\n{body}\n{body}\n{body}\n- {k + 4} -") for k in range(1, 9)]
    pages[2] = (3, 3, f"REGISTRY OF MARKETS   7\n{body}\nThe docurnentation of the mar-\nket and the well-\npreserved mar|ket.\n12\n{body}")
    pages += [(50, 50, None), (51, 51, ""), (1, 1, pages[0][2])]
    found, p, b = noise(spark, pages, [(7, 3, 0, "Registry of Markets 7", "Page-header"), (8, 3, 1, None, "Text")])
    third = {(line, kind) for src, row, line, kind in found if src == "page" and row == 3}
    assert third == {(0, "header"), (3, "char"), (3, "hyphen"), (5, "char")}
    first = {(line, kind) for src, row, line, kind in found if src == "page" and row == 1}
    assert first == {(0, "header"), (7, "page_number")}
    assert ("block", 7, 0, "header") in found and not [f for f in found if f[:2] in (("page", 50), ("page", 51), ("block", 8))]
    text = "\n".join(r.text for r in scannoise.paragraphs(p, b).where("page_id = 3").orderBy("paragraph_no").collect())
    assert "The documentation of the market and the well-preserved market." in text and "REGISTRY" not in text


def test_blocks_are_repaired_as_pages_are(spark):
    body = "The documentation of the well-preserved market was found\nbeside the documentation of the market."
    pages = [(k, k, f"Registry of Markets\n{body}\n{body}\n- {k + 4} -") for k in range(1, 9)] + [(60, 60, None)]
    misread = "The docurnentation of the mar-\nket and the well-\npreserved  mar|ket|s\n\nby  the market."
    blocks = [(7, 3, 0, "Registry of Markets 7", "Page-header"), (8, 3, 1, misread, "Text"), (9, 60, 0, misread, "Text"), (10, 3, 2, None, "Text"), (11, 3, 3, " \n", "Text")]
    _, p, b = noise(spark, pages, blocks)
    out = [tuple(r) for r in scannoise.paragraphs(p, b).collect()]
    repaired = ["The documentation of the market and the well-preserved markets", "by the market."]
    # A page of which only blocks have text counts as well.
    assert {r for r in out if r[0] == "block"} == {("block", i, page, k, t) for i, page in ((8, 3), (9, 60)) for k, t in enumerate(repaired)}
    assert {r[1] for r in out if r[0] == "page"} == set(range(1, 9)) and len(out) == len(set(out))


def test_texts_of_one_load_stay_apart(spark):
    body = "The documentation of the old wide market was found\nbeside the documentation of the market."
    pages = [(k, k, f"Registry of Markets\n{body}\n- {k + 4} -") for k in range(1, 9)]
    long = "It stood beside the documentation of the market, near the old river."
    pages += [(3, 3, f"{long}\nIt stood beside the documentation of the wide old mar-\nket near the documentation of the town and river.\n{long}")]
    _, p, b = noise(spark, pages)
    text = " ".join(r.text for r in scannoise.paragraphs(p, b).where("page_id = 3").orderBy("paragraph_no").collect())
    middle = "It stood beside the documentation of the wide old market near the documentation of the town and river."
    assert text in (body.replace("\n", " "), f"{long} {middle} {long}")


def test_headings_that_recur_far_away_are_no_titles(spark):
    body = "The documentation of the market was found\nbeside the documentation of the market."
    first = {n: "Registry of Markets" for n in (*range(1, 9), *range(5001, 5009))}
    first |= {4: "Old Clay Roads", 5004: "Old Clay Roads"}  # a heading, twice by chance
    first |= {6: "Village Letters", 5005: "Village Letters", 5007: "Village Letters"}  # a title that mostly recurs near
    found, _, _ = noise(spark, [(10_000 + n, n, f"{t}\n{body}\n{body}\nand so on.") for n, t in first.items()])
    headers = {row - 10_000 for _, row, line, kind in found if kind == "header" and line == 0}
    assert headers == set(first) - {4, 5004}


def test_noise_of_nothing(spark):
    found, p, b = noise(spark, [(1, 1, None)])
    assert found == set() and scannoise.paragraphs(p.limit(0), b).count() == 0


# languages ------------------------------------------------------------------------------------------------------------------

EN = "the market of the old town was near the river and the green door of the school"
HI = "पुराना बाज़ार नदी के साथ है और लड़की घर में है क्योंकि पानी लाल था"
MR = "जुना बाजार नदी जवळ आहे आणि मुलगी घर मध्ये आहे कारण पाणी लाल होते"
HL = "purana bazaar nadi ke saath hai aur ladki ghar mein hai kyunki pani laal tha"


def test_labels(spark):
    cases = {"hi": "hi", "Hindi": "hi", " HINDI ": "hi", "hi-IN": "hi", "hi_IN": "hi", "und": None, "": None, None: None, "n/a": None, "unknown": None, "odia": "or", "xx": None}
    rows = spark.createDataFrame([(k,) for k in cases], "lang string")
    assert [r[0] for r in rows.select(languages.label_code(rows.lang)).collect()] == list(cases.values())


def test_unknown_words_stay_unknown_beside_a_large_vocabulary():
    features = languages.Features()
    seen = {features(f"w{chr(97 + k % 26)}{k // 26:b}".translate({48: "o", 49: "l"}))[0][0] for k in range(60_000)}
    new = [features(f"n{chr(97 + k % 26)}{k // 26:b}".translate({48: "o", 49: "l"}))[0][0] for k in range(5_000)]
    assert sum(b in seen for b in new) < 0.1 * len(new)


def test_pages_and_blocks(spark):
    pages = []
    for k in range(30):
        text, lang = [(EN, "en"), (HI, "Hindi"), (MR, "mr-IN")][k % 3]
        pages.append((k, f"x_{k % 4}.pdf", lang, "\n".join([text] * 4), k))
    pages += [(30 + k, "scan.pdf", "hi", "\n".join([HL] * 4), k) for k in range(4)]
    pages += [
        (100, "a.pdf", "en", "\n".join([HI] * 4 + [EN]), 1),
        (101, "b.pdf", None, MR, 1),
        (102, "c.pdf", "en", HL + "\n" + HL, 1),
        (103, "d_hindi.pdf", None, None, 1),
        (104, None, "hi", "१२ ३४", 1),
        (105, "e.pdf", "mr", EN, 1),
        (105, "e.pdf", "mr", EN, 2),
    ]
    p = spark.createDataFrame(pages, "page_id long, file string, lang string, full_text string, loaded_at int")
    notes = [(1, [HI, HI, EN, "the old town", None, ""]), (2, None), (3, [])]
    a = spark.createDataFrame(notes, "ann_id long, block_text array<string>")
    found = {tuple(r) for r in languages.mislabelled(p, a.union(a)).collect()}
    assert found == {("page", 100, -1, "hi"), ("page", 101, -1, "mr"), ("page", 102, -1, "hi"), ("page", 105, -1, "en"), ("block", 1, 2, "en")}
    every = {(r.src, r.row_id): r for r in languages.languages(p, a).collect()}
    assert every["page", 103].lang == "hi" and 0 <= every["page", 103].confidence <= 1


@pytest.mark.parametrize("word,code", [("register_hindi_0001.pdf", "hindi"), ("scan_0001.pdf", "scan"), ("x.pdf", "x")])
def test_name_word(spark, word, code):
    rows = spark.createDataFrame([(word,)], "file string")
    assert rows.select(languages.name_word(rows.file)).first()[0] == code
