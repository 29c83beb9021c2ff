import pytest
from pyspark.sql import functions as F

from corpusloom.operators import cleaners, typography, wikitext
from corpusloom.operators.citations import strip_citations


def column(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, text string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("text"))).collect()]


def test_citations(spark):
    cases = {
        "годзе [1] X": "годзе X",
        "claim.[5] X": "claim. X",
        "a [12][a] b": "a b",
        "x [Citation Needed] y": "x y",
        "x [ who? ] y": "x y",
        "x [note 12], y [n 3]": "x, y",
        "x [dubious – discuss] y": "x y",
        "x [sic] y": "x [sic] y",
        "in [2024] y": "in [2024] y",
        "He [the president] said": "He [the president] said",
        "[ab] [1a]": "[ab] [1a]",
        "x [ 5 ] y": "x y",
        "": "",
    }
    assert column(spark, strip_citations, [*cases, None]) == [*cases.values(), None]


def test_nfkc():
    assert cleaners.nfkc("ﬁne ＡＢ Ⅻ x²") == "fine AB XII x2"
    assert cleaners.nfkc("ёйў й за́мак") == "ёйў й замак"
    assert cleaners.nfkc("plain") == "plain" and cleaners.nfkc("") == ""
    assert cleaners.nfkc("क्ः") == "कः"  # class 0 marks stay


def deep(text, rounds):
    """UTF-8 read as latin-1 so many times."""
    for _ in range(rounds):
        text = text.encode().decode("latin-1")
    return text


@pytest.mark.parametrize(
    ("damaged", "clean"),
    [
        ("schÃ¶n", "schön"), ("clean text", "clean text"), ("schön", "schön"), ("cafÃ© &eacute; naïve", "café é naïve"), ("a &lt; b", "a < b"), ("<b>&lt;</b>", "<b>&lt;</b>"),
        ("“curly” ‘x’", "\"curly\" 'x'"), ("ﬂat", "flat"), ("a\r\nb\rc", "a\nb\nc"), ("\x1b[31mred\x1b[0m", "red"), ("x\x00y", "xy"), ("ＡＢ", "AB"), ("é", "é"),
        (deep("schön", 7), "schön"), (deep("привет", 3) + " ж", "привет ж"), ("Ã©Ã x é", "éÃ x é"),
        ("Ð¿Ñ€Ð¸Ð²ÐµÑ‚", "привет"), ("привет", "привет"), ("les élèves é è", "les élèves é è"), ("", ""),
    ],
)
def test_repair(damaged, clean):
    got, steps = cleaners.repair(damaged)
    assert got == clean and bool(steps) == (damaged != clean)


@pytest.mark.parametrize("text", ["Èéé.", "La Èèêtre", "ÍñíÓñó", "Úžas", "Úžasný", "Spaß”", "„Spaß“ é", "mangé…» ici"])
def test_repair_leaves_good_texts(text):
    assert cleaners.repair(text) == (text.replace("”", '"').replace("„", '"').replace("“", '"'), ["apply"] if {*"”„“"} & {*text} else [])
    assert cleaners.repair(text + " schÃ¶n cafÃ©")[0] == cleaners.repair(text)[0] + " schön café"


@pytest.mark.parametrize("page", ["latin-1", "cp1252", "cp1251", "cp1250", "mac_roman"])
@pytest.mark.parametrize("text", ["schön", "привет, свет", "“да”", "日本語", "žluťoučký"])
def test_repair_reads_each_code_page(text, page):
    try:
        damaged = text.encode().decode(page)
    except UnicodeDecodeError:
        return
    assert cleaners.repair(damaged)[0] == text.replace("“", '"').replace("”", '"')


def test_registered_mojibake_of_good_texts(spark, tmp_path):
    """Short texts that are UTF-8 in macroman: each query against its SQL."""
    import duckdb

    from corpusloom.plans import catalogue

    rows = [(i, t) for i, t in enumerate(t for t in ("Èéé.", "ÍñíÓñó", "Úžas", "x") for _ in range(5))]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(path)
    for name in ("clean_mojibake", "mojibake_kinds"):
        with duckdb.connect() as c:
            c.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
            want = c.execute(catalogue.ORACLE_SQL[name]).fetchall()
        assert sorted(map(tuple, catalogue.QUERIES[name](spark, str(tmp_path)).collect())) == sorted(want)


def test_sparse_output_and_flag(spark):
    df = spark.createDataFrame([(1, "x [1]"), (2, "y"), (3, None)], "i int, text string")
    got = {r.i: (r.text, r.out, r.changed) for r in cleaners.clean_citations(df, output_field="out", flag="changed").collect()}
    assert got == {1: ("x [1]", "x", True), 2: ("y", None, False), 3: (None, None, False)}
    with pytest.raises(ValueError, match="missing"):
        cleaners.clean_nfkc(df, "absent")


@pytest.mark.parametrize(
    ("markup", "shown"),
    [
        ("no markup  here", "no markup  here"), ("[[Менск]] і [[Вільня|Вільні]]", "Менск і Вільні"), ("'''bold''' ''it''", "bold it"), ("== Head ==\ntext", "Head text"),
        ("{{bt-bellat|а|b}}x", "аx"), ("{{bt-latbel||b}}", "b"), ("{{bt-bellat|[[A{{!}}B]]|c}}", "B]]"), ("{{нп3|Adam|Адам}}", "Адам"), ("{{нп|Adam|}}", "Adam"),
        ("{{lang-en|London|x=1}}", "London"), ("{{lang|be|слова}}", "слова"), ("a{{!}}b {{", "a|b {{"), ("{{cite web|url=http://x}} t", "t"), ("{{unknown|{{lang-en|x}}}} t", "t"),
        ("{{lang-en|a {{b}} c}}", "a c"), ("x<ref name=a>no</ref> y [[z]]", "x y z"), ("<ref/> <b>t</b> ''u'' &amp; <!-- c -->", "t u &"), ("[http://a.b title] ''x'' [http://c.d]", "title x"),
        ("[[Файл:a.jpg|thumb|[[x|y]] z]]", "thumb|y z"), ("{{нп5|a|{{lang-en|b}}}}", ""), ("", ""),
    ],
)
def test_wiki_markup(markup, shown):
    assert wikitext.clean(markup) == shown


@pytest.mark.parametrize(
    ("text", "clean"),
    [
        ("Мiнск", "Мінск"), ("I быў", "І быў"), ("I am", "I am"), ("пасьля", "пасля"), ("Пасьля вайны", "Пасля вайны"), ("(пасьля)", "(пасля)"), ("у Токіо", "уТокіа"),
        ("аб'яднанне", "аб’яднанне"), ("&copy; &deg; (tm)", "© ° ™"), ("так...", "так…"), ("10 <sup>2</sup>", "10 ²"), ("x^2 y", "x² y"), ("№№ 5", "№ 5"),
        ("слова -- слова", "слова — слова"), ("1--2", "1—2"), ("тэмп -5", "тэмп −5"), ("у 1918-1920 гг.", "у 1918—1920 гг."), ("XIX-XX стст.", "XIX-XX стст."),
        ("5 км, далей", "5 км, далей"), ("слова.Слова", "слова. Слова"), ("слова ,слова", "слова, слова"), ("каля 20 °C.", "каля 20 °C."), ("за 5.5 %", "за 5,5 %"), ("( а )", "(а)"),
        ("ён «так» .", "ён «так» ."), ("ён \"кажа \"так\" ім\" .", "ён «кажа „так“ ім» ."), ("а  б\t\tв", "а б в"), ("што́ там", "што́ там"), ("", ""),
    ],
)
def test_typography(text, clean):
    assert typography.clean(text, typography.Lexicon(typography.STARTER))[0] == clean


def test_typography_switches_and_fires():
    assert typography.clean("пасьля -- так", None, typos=False, dashes=False) == ("пасьля -- так", {})
    assert typography.clean("Сьвет сьвет", typography.Lexicon(typography.STARTER), typos=False)[1] == {"replacements[сьвет]": 2}
    assert len(typography.spelling_rules()) == 191


def test_needles_never_hide_a_match():
    for pattern, _, needle in typography.spelling_rules():
        for text in ("У Токіо", "менеджмент", "на меншы", "сезон 2004 году", "у залі", "Эўропа", "эўропы", "мінімум"):
            if pattern.search(text):
                assert needle in text


def test_needs_never_hide_a_match():
    """Each group by all of its rules, and by those whose needs are met, over random texts; few rules are tried on a plain text."""
    import random

    bits = [*"аоеіўАВЕІмгтcCСaxXFIV015 \t\n\r '’ʼ\"«»„“.,;:!?()[]<>-–—+−%‰°^*№§&~=|\u00a0\u00ad٣", *"      ", "&copy;", "&HELLIP;", "&hellip;", "&TRADE;", "(TM)", "...", "+-", "--", "~=", "&quot;", "<sup>2</sup>", "&SUP3;", "^2", "^3", "<<a", "b>>"]
    bits += ["№№", " \r\n", "гг.", "стст.", "млн", "трлн", "тыс", "ISBN: 123456789", "1918", "1 ", "°C ", " C,", " F.", "А.", "Пу", "sub>", "abc"]
    rnd = random.Random(5)
    for _ in range(20_000):
        text = "".join(rnd.choices(bits, k=rnd.randint(1, 20)))
        for name in ("core", "dashes", "nbsp", "collapse"):
            for pattern, _, needs in typography._compiled(name):
                assert typography._may_match(text, set(text), needs) or not pattern.search(text), (text, pattern.pattern)
    plain = "Plain words, more of them; and a number, 12, at the end.\nA line."
    tried = [p.pattern for name in ("core", "dashes", "nbsp") for p, _, needs in typography._compiled(name) if typography._may_match(plain, set(plain), needs)]
    assert tried == []


def test_lexicon_files(tmp_path):
    path = tmp_path / "pairs.txt"
    path.write_text("# c\nа=б\nа=в\nг = д\n\nx\nе=е\n", encoding="utf-8")
    assert typography.load_lexicon(str(path)) == {"а": "в", "г": "д"}
    path.write_text("# nothing\n", encoding="utf-8")
    with pytest.raises(RuntimeError):
        typography.load_lexicon(str(path))
    with pytest.raises(FileNotFoundError):
        typography.load_lexicon(str(tmp_path / "none"))
