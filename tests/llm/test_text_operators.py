import unicodedata

import pandas as pd
import pytest

from quarryline.llm import language, lookalikes, mojibake, quality, residue

META = "domain string, language string, title string, description string"


# ---- language ------------------------------------------------------------------------------------------------

ENGLISH = ["We ship the goods to the port and our team answers on the same day.", "The family still owns the company and they check every batch before it leaves.", "You can visit the plant and see how the seed is cleaned and packed."]
GERMAN = ["Wir liefern die Ware zum Hafen und unsere Mitarbeiter antworten am selben Tag.", "Die Familie besitzt das Unternehmen noch heute und prüft jede Lieferung.", "Sie können das Werk besuchen und sehen, wie die Saat gereinigt wird."]
RUSSIAN = ["Мы отправляем товар в порт, и наши сотрудники отвечают в тот же день.", "Семья до сих пор владеет фирмой и проверяет каждую партию.", "Вы можете посетить завод и увидеть, как очищают семена."]


@pytest.fixture(scope="module")
def model():
    rows = [(t, l) for l, ts in (("en", ENGLISH), ("de", GERMAN), ("ru", RUSSIAN)) for t in ts]
    rows.append((GERMAN[0], "en"))  # a wrong label
    return language.fit(pd.DataFrame(rows, columns=["text", "lang"]), landmarks=5)


def test_language_of_segments(model):
    (seen,) = model.segments([f"{ENGLISH[0]} {GERMAN[1]}"])
    assert [(l, whole) for _, l, _, whole in seen] == [("en", True), ("de", True)]
    assert all(0 < c <= 1 for _, _, c, _ in seen)
    assert model.segments([None, "", "123 -- 456"]) == [[], [], []] and model.segments([]) == []
    assert len(model.segments([ENGLISH[0] + " " + ENGLISH[1] * 2000])[0]) >= 2


def test_kernel_scores_equal_the_product_of_matrices(model):
    import numpy as np

    text = ENGLISH[1]
    grams = set().union(*[language.grams(w) for w in set(language.WORD.findall(text.lower()))])
    brute = sum((model.weights[model.ids[g]] for g in grams if g in model.ids), np.zeros(len(model.languages))) / len(grams) ** 0.5
    assert np.allclose(model.scores([language.WORD.findall(ENGLISH[0]), language.WORD.findall(text), []])[1], brute, atol=1e-5)
    assert np.allclose(model.scores([language.WORD.findall(text)])[0], brute, atol=1e-5)


def test_confidence_is_calibrated_on_held_out_rows():
    rows = [(f"{a} {b}", l) for l, ts in (("en", ENGLISH), ("de", GERMAN), ("ru", RUSSIAN)) for a in ts for b in ts]
    texts, labels = [t for t, _ in rows], __import__("numpy").array([l for _, l in rows])
    sure = language.calibrated(texts, labels, 5, 0.3)
    labels[::3] = "en"  # wrong labels make it less sure
    assert 1 <= language.calibrated(texts, labels, 5, 0.3) < sure <= 30
    assert language.calibrated(texts[:1], labels[:1], 5, 0.3) == 6.0


def test_labels():
    assert [language.label_language(x) for x in ("en_GB", "EN", "Deutsch", "zh-Hans", "русский")] == ["en", "en", "de", "zh", "ru"]
    assert [language.label_language(x) for x in (None, "", "und", "x-default", "-", "mul")] == [None] * 6


def test_fit_needs_labels():
    with pytest.raises(ValueError):
        language.fit(pd.DataFrame({"text": [], "lang": []}))


def test_misdeclared(spark, model):
    rows = [("a", "en", None, ENGLISH[0]), ("a", "en", None, ENGLISH[0]), ("b", None, None, GERMAN[0]), ("c", "de", None, f"{ENGLISH[0]} {GERMAN[1]}"), ("d", "xx", None, None), ("e", "ru", None, " "), ("f", None, None, ENGLISH[1])]
    df = spark.createDataFrame(rows, META)
    out = language.misdeclared(language.suspects(df, model), spark.createDataFrame([("f",)], "domain string")).collect()
    assert sorted(map(tuple, out)) == [("b", "de"), ("c", "de"), ("c", "en")]
    assert language.misdeclared(language.suspects(df.limit(0), model), df.limit(0)).count() == 0


# ---- residue -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text",
    ["{{ company.name }}", "Welcome to {!! $title !!}", "[[+city]] | Acme", "%%title%%", "<%= x %>", "&lt;%= x %&gt;", "@@city@@", "###name###", "#{brand}", "{0} - {1}", "%1$s : %2$s", "<!--#title-->", "COMPANY_NAME_HERE", "[Your Company Name]", "(enter product here)",
     "Lorem ipsum dolor sit amet", "Texto de relleno para la maqueta.", "Blindtext für die Vorschau", "undefined | undefined", "Sample page 3 - sample text", "HTTP 404 – that link cannot be found", "The page was moved or removed.", "Страница не найдена", "页面未找到",
     "Access denied", "Fatal error: uncaught exception in /srv/x on line 3", "This site will not run without Javascript turned on.", "Включите JavaScript", "请启用JavaScript", "noscript", "We are verifying that you are human."],
)
def test_residue_is_found(text):
    assert residue.residue_kind(text)
    assert residue.residue_kind("We sell steel. " + text) or text.startswith(("Sample", "undefined", "noscript", "HTTP", "Access"))


@pytest.mark.parametrize(
    "text",
    [None, "", "  ", "100% Cotton & 50% Linen", "Acme [ISO 9001] Template-Cut Gaskets", "Our 404 and 503 series pumps move pepper.", "We build JavaScript dashboards for ports.", "Null Point Calipers", "Sit & Dolor Wines", "Acme ($/MT price list)",
     "Not Found Elsewhere Spices", "Dummy plugs and sample cases are made here.", "Access to the yard is denied to trucks without a permit.",
     "In Jinja templates you write values such as {{ name }} between double braces.", "A tutorial on how to fix the message 404 Not Found on your own server, for beginners.", "Use `{{ name }}` for it."],
)
def test_business_text_is_not_residue(text):
    assert residue.residue_kind(text) is None


@pytest.mark.parametrize(
    "text",
    ["You are not authorized to view this page.", "You are not allowed to view this.", "Internal server failure", "Internal server problem", "This page is unable to load", "The page fails to load", "Replace this text", "Insert this title",
     "My Store", "My Blog", "My Shop", "New document", "Platzhalter", "占位符", "在此插入", "在此添加", "SİTE UNDER CONSTRUCTION", "officia deserunt mollit anim"],
)
def test_prefilter_keeps_what_the_rules_match(text, monkeypatch):
    kept = residue.residue_kind(text)
    monkeypatch.setattr(residue, "cued", lambda low: set(residue._CUES))
    assert kept == residue.residue_kind(text) is not None


@pytest.mark.parametrize(
    ("text", "kind"),
    [("{{ " + "a" * 500 + " }}", "placeholder"), ("<!-- " + "a b " * 90 + "-->", "placeholder"), ("[insert " + "x y " * 60 + "]", "placeholder"), ("Such as {{ name }}", "placeholder"), ("Our developers: the page you requested could not be found", "error"),
     ("Grade: 404 Not Found", "error"), ("Pumps 500 Internal Server Error", "error"), ("503: backend error", "error"), ("404: the document you asked for failed to render", "error"), ("Cookies and scripts must be allowed before the catalogue can load.", "script"),
     ("Bitte schalten Sie JavaScript ein, um diese Seite zu sehen.", "script")],
)
def test_no_length_or_word_of_business_hides_residue(text, kind):
    assert residue.residue_kind(text) == kind


def test_each_rule_tells_what_its_matches_hold():
    needed = lambda p: residue.needed(residue._parser.parse(p, residue.re.I))
    assert needed("(?:page|site)s? is (?:gone|missing)") == {"page is gone", "page is missing", "pages is gone", "pages is missing", "site is gone", "site is missing", "sites is gone", "sites is missing"}
    assert needed(r"\w+(?:a|b)?") is None and needed("x{3,}[ _-]a?") == {"xxx"}
    assert all("" not in cues and " " not in cues for cues in residue._CUES.values())


def test_residue_fields(spark):
    df = spark.createDataFrame([("a", None, "{{x}}", None), ("a", None, "{{x}}", ""), ("b", None, "Fine goods", "x " * 50000 + ". [[name]]")], META)
    assert sorted(map(tuple, residue.residue_fields(df).select("domain", "field").collect())) == [("a", "title"), ("b", "description")]
    assert residue.residue_fields(df.limit(0)).count() == 0


# ---- look-alikes ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("text", "form"), [("Ꭺargo", "Aargo"), ("סargo", "oargo"), ("Ⲁcme", "Acme"), ("日本語カタカナ", None), ("ひらがな漢字", None), ("한국 漢字", None), ("Σoftware", None)])
def test_script_sets_are_intersected(text, form):
    assert lookalikes.canonical(text) == (form or text, form is not None)


def test_resolved_script_sets():
    assert lookalikes.resolved("カタ漢字") == {"Jpan"} and lookalikes.resolved("12-") is None and lookalikes.resolved("Cаrgo") == frozenset()
    assert lookalikes.read_confusables(["0531 ; 0055 ; MA # x", "# none", "0441 0442 ; 0063 ; MA"]) == {"\u0531": "U"}
    assert lookalikes.canonical("\u0531ber", {"\u0531": "U"}) == ("Uber", True)


@pytest.mark.parametrize(
    ("text", "form"),
    [("ｃａｆｅ", "cafe"), ("jo@p​ost.example", "jo@post.example"), ("exаmple.cоm", "example.com"), ("Zoë", "Zoë"), ("a\u00a0b", "a b"), ("tel‑1", "tel-1"), ("ﬁne", "fine"), ("Вepa Caxapов", None), ("со@post.example", "co@post.example")],
)
def test_lookalikes(text, form):
    out, found = lookalikes.canonical(text)
    assert found and (form is None or out == form)
    assert lookalikes.canonical(out) == (out, False)


@pytest.mark.parametrize("text", ["", "plain", "Zoë", "Борис Пунгарин", "वीरन दोलकर", "كريم دلواني", "托明希", "https://x.example/торг-экспорт", "  a  B "])
def test_usual_text_stays(text):
    assert lookalikes.canonical(text) == (text, False)
    assert unicodedata.normalize("NFC", text) == text


def test_lookalike_rows(spark):
    df = spark.createDataFrame([(1, "plain", 1), (2, "cоm", 2), (3, None, 3), (4, "cоm" * 3000, 4)], "id long, value string, canonical int")
    assert [r.id for r in lookalikes.lookalike_rows(df, "id", "value", "f").orderBy("id").collect()] == [2, 4]
    out = lookalikes.with_canonical(df, "value", "form").orderBy("id").collect()
    assert [r.form for r in out][:3] == ["plain", "com", None] and [r.lookalike for r in out] == [False, True, False, True]


# ---- wrong decoding ------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("clean", "writer", "reader"), [("für", "utf-8", "cp1252"), ("Компания", "utf-8", "cp1252"), ("żółć", "utf-8", "cp437"), ("公司成立", "utf-8", "mac_roman")])
def test_undo_is_the_inverse(clean, writer, reader):
    try:
        garbled = clean.encode(writer).decode(reader)
    except UnicodeDecodeError:
        garbled = "".join(bytes([b]).decode(reader, "ignore") or chr(b) for b in clean.encode(writer))
    assert mojibake.undo("".join(mojibake.RUN.findall(garbled)), f"utf8>{reader}>1") == "".join(mojibake.RUN.findall(clean))


@pytest.mark.parametrize("clean", ["Müller", "Łódź", "São João", "naïve—façade", "Çağla", "żółć", "привет", "€5", "中文文本"])
def test_alignment_explains_what_undoing_brings_back(clean):
    for p in mojibake.PAIRS:
        writer, reader, times = p.split(">")
        now = clean
        try:
            for _ in range(int(times)):
                data = b"".join(bytes([ord(c)]) if c.isascii() else c.encode("utf-8" if writer == "utf8" else writer) for c in now)
                now = mojibake._mangled(data, reader)
        except UnicodeEncodeError:
            continue
        if now is None or now == clean or mojibake.RUN.split(now) != mojibake.RUN.split(clean):
            continue
        assert p in mojibake.explained(now, clean), p
        assert all(mojibake.undo(x, p) == y for x, y in zip(mojibake.RUN.findall(now), mojibake.RUN.findall(clean), strict=True) if x != y), p


def test_restoring(spark):
    clean = "Wir kümmern uns um Zölle für Käufer"
    rows = [(f"d{i}", "title", clean) for i in range(4)] + [("g", "title", clean.encode().decode("cp1252")), ("q", "title", clean.replace("ü", "?")), ("n", "title", None), ("e", "title", ""), ("w", "title", "Who? Where?? Here – “there”")]
    out = {r.domain: r for r in mojibake.restore(spark.createDataFrame(rows, "domain string, field string, text string")).collect()}
    assert set(out) == {"g", "q"} and out["g"].restored == out["q"].restored == clean
    assert mojibake.restore(spark.createDataFrame([], "domain string, field string, text string")).count() == 0


def test_signs_of_all_texts_tell_lone_marks(spark):
    rows = spark.createDataFrame([("a", "title", "Port – Trade"), ("b", "description", "Harbor ? Trade")], "domain string, field string, text string")
    out = mojibake.restore(rows, rows.filter("field = 'description'")).collect()
    assert [(r.domain, r.field, r.kind) for r in out] == [("b", "description", "lost")]


def _shared(hot, clean, copies):
    return [(f"h{i}", "description", hot) for i in range(copies)] + [(f"c{i}", "description", t) for i, t in enumerate(clean)]


def test_hot_garbled_text_is_no_clean_twin(spark):
    parts = ["ко", "ра", "ли", "пе", "то", "ва", "но", "ми", "са", "ду"]
    words = [a + b + c for a in parts for b in parts for c in parts[:6]]
    clean = [" ".join(words[i : i + 12]) for i in range(0, len(words), 12)]
    text = " ".join(words[::40])
    rows = spark.createDataFrame(_shared(text.encode("cp1251").decode("cp1252"), clean, 200), "domain string, field string, text string")
    out = {r.domain: r.restored for r in mojibake.restore(rows).collect()}
    assert set(out) == {f"h{i}" for i in range(200)} and out["h0"] == text


def test_hot_garbled_letters_among_ascii_are_no_clean_twins(spark):
    words = [f"{a}{u}{b}" for a in ("k", "gr", "m", "st", "w", "br") for u in "üöä" for b in ("hlen", "rmer", "fte", "nner", "sse")]
    clean = [" ".join(words[i : i + 6]) for i in range(0, len(words), 6)]
    text = " ".join(words[::9])
    rows = spark.createDataFrame(_shared(text.encode("cp1252").decode("cp1251"), clean, 40), "domain string, field string, text string")
    out = {r.domain: r.restored for r in mojibake.restore(rows).collect()}
    assert set(out) == {f"h{i}" for i in range(40)} and out["h0"] == text


# ---- quality -------------------------------------------------------------------------------------------------

PROSE = "We ship the goods to the port every week. The family still owns the company, and they check every batch before it leaves."
TABLE = "code;item;qty\n" + "\n".join(f"A-{i};pepper;{i * 7}" for i in range(20))


def test_exact_ranks_match_brute_force(spark):
    values = [("s", "en", float(v)) for v in [3, 1, 1, 2, 5, 5, 5, 0]] + [("s", "de", 1.0), ("t", "en", 2.0)]
    out = {(r.statistic, r.lang, r.value): (r.at_most, r.at_least) for r in quality.exact_ranks(spark.createDataFrame(values, "statistic string, lang string, value double")).collect()}
    for s, l, v in values:
        group = [x for a, b, x in values if (a, b) == (s, l)]
        assert out[s, l, v] == (sum(x <= v for x in group), sum(x >= v for x in group))


def test_verdicts(spark):
    texts = [PROSE, TABLE, "", None, "Pepper\nSalt\nRice\nOil", PROSE + "\n- pepper\n- salt", "Heading\n\n" + PROSE, PROSE * 500, "#" * 3000, TABLE, PROSE.replace(" ", "\n", 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.is_prose for r in quality.scored(df).collect()}
    assert [i for i, ok in sorted(out.items()) if not ok] == [1, 2, 3, 4, 8, 9]
    assert quality.scored(df.limit(0)).count() == 0


def test_verdicts_where_junk_dominates_or_stands_alone(spark):
    korean = "목록;수량\n" + "\n".join(f"{i};{i * 3}" for i in range(9))
    german = "Wir liefern die Ware zum Hafen und unsere Mitarbeiter antworten am selben Tag. Die Familie besitzt das Unternehmen noch heute."
    lists = "die und der\n" + "\n".join(f"Pfeffer {i};{i * 7}" for i in range(20))
    texts = [lists] * 60 + [german, PROSE, korean, "Liste der Waren und Preise\n" + "\n".join(["Salz;1", "Reis;2", "Mehl;3"] * 4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in quality.scored(df).collect()}
    assert [i for i, r in sorted(out.items()) if r.is_prose] == [60, 61]
    assert out[0].outlier_score == out[59].outlier_score > 0
    alone = spark.createDataFrame([(1, TABLE), (2, german)], "doc_id long, text string")
    assert {r.doc_id: r.is_prose for r in quality.scored(alone).collect()} == {1: False, 2: True}
