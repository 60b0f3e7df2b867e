from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabularium import functions as fn
from tabularium.functions.html import live_markup

D = dt.date


def test_pad_key_never_makes_one_key_of_two(values):
    rows = [12, 0, 12345678, 123456781, 123456789, None]
    assert values(rows, "k long", fn.pad_key(F.col("k"), 8)) == ["00000012", "00000000", "12345678", None, None, None]
    kept = values(rows, "k long", fn.pad_key(F.col("k"), 8, overflow="keep"))
    assert kept == ["00000012", "00000000", "12345678", "123456781", "123456789", None]
    assert values(rows, "k long", fn.pad_key(F.col("k"), 8, overflow="cut"))[3:] == ["12345678", "12345678", None]
    with pytest.raises(ValueError):
        fn.pad_key(F.col("k"), 8, overflow="x")


def test_links_in_every_way_of_quoting(values):
    html = "<a href='x'><A HREF=\"y\"><a class=k href=z><a href=\"w\"><a href = \"q\"><a name=\"no\"><a href=\"it's\">"
    assert values([html], "h string", fn.extract_links(F.col("h"))) == [["x", "y", "z", "w", "q", "it's"]]


def test_text_and_phone_through_nested_elements(values):
    text = '<div class="VwiC3b yXK7lf MUxGbd yDYNvb lyLwlc lEBKkf">one <div>two</div> three</div><div>no</div>'
    side = '<div id="rhs"><span class="LrzXr zdqRlf kno-fv"><span>(41)</span> 3333</span><span>9</span></div>'
    html = f'<div id="rso"><div class="MjjYud"><a href="l">t</a>{text}</div><div class="MjjYud"></div></div>{side}'
    found = values([html], "h string", fn.extract_results(F.col("h"), fn.SEARCH_PAGE))
    assert [tuple(r) for r in found[0]] == [(0, "l", "one two three")]
    layout = fn.SEARCH_PAGE
    phone = fn.extract_phone(F.col("h"), layout.phone, element=layout.phone_element)
    assert values([html], "h string", phone) == ["(41) 3333"]


def test_a_page_is_read_as_a_parser_sees_it(values):
    text = '<div class="VwiC3b yXK7lf MUxGbd yDYNvb lyLwlc lEBKkf">one <!-- </div> --> two<script>"</div>"</script> three</div>no'
    inside = '<!-- <a href="dead">x</a> <div class="MjjYud"> --><script>var a = "<a href=\'dead2\'>";</script>'
    side = '<!-- <div id="rhs"><span class="LrzXr zdqRlf kno-fv">1</span> --><div id="rhs"><span class="LrzXr zdqRlf kno-fv">(4<!--</span>-->1) 3</span></div>'
    html = f'<div id="rso"><div class="MjjYud">{inside}<a href="l">t</a>{text}</div><div class="MjjYud"></div></div>{side}'
    found = values([html], "h string", fn.extract_results(F.col("h"), fn.SEARCH_PAGE))
    assert [tuple(r) for r in found[0]] == [(0, "l", "one  two three")]
    assert values([html], "h string", fn.extract_links(F.col("h"))) == [["l"]]
    layout = fn.SEARCH_PAGE
    assert values([html], "h string", fn.extract_phone(F.col("h"), layout.phone, element=layout.phone_element)) == ["(41) 3"]


def test_tokens_of_a_page(values):
    rows = {
        "a<!-->b<!--->c<!-- x --!>d<!-- -- > -->e": "abcde",
        "a<!-- open <b>": "a",
        "<!DOCTYPE html><?x y?>a<![CDATA[b]]>c": "ac",
        '<p title="<!-- no -->">a</p>': '<p title="<!-- no -->">a</p>',
        "<p don't>a</p><p isn't>b</p>": "<p don't>a</p><p isn't>b</p>",
        "a < b <3 c": "a < b <3 c",
        "<style>p > a {}</style><script src='a>b'>x</script >y": "y",
        "<script>open <b>x</b>": "",
        None: None,
        "": "",
    }
    assert values(list(rows), "t string", live_markup(F.col("t"))) == list(rows.values())
    huge = f'<img src="data:{"x" * 2_000_000}">' + "<b " + " ".join(f'a{i}="<!--"' for i in range(3000)) + ">z</b>" + "<!--" + "y>" * 500_000 + "-->"
    assert values([huge], "t string", F.length(live_markup(F.col("t")))) == [huge.index("<!--y")]


def test_names_of_html_5(values):
    rows = ["&check;&NotEqualTilde;&hellip;", "&CounterClockwiseContourIntegral;&nosuchname;"]
    assert values(rows, "t string", fn.unescape_entities(F.col("t"))) == ["\u2713\u2242\u0338\u2026", "\u2233&nosuchname;"]


def test_padded_and_named_references(values):
    rows = ["&apos;", "&#00000233;", "&#x00000E9;", "&#233;", "&#99999999;", "&#0;"]
    assert values(rows, "t string", fn.unescape_entities(F.col("t"))) == ["'", "é", "é", "é", "&#99999999;", "&#0;"]


def test_compose_key_needs_all_parts(values):
    parts = [F.col("a"), F.col("b"), F.col("c")]
    got = values([(12, 1, 5), (12, None, 5)], "a long, b short, c short", fn.compose_key(parts))
    assert got == ["00000012000105", None]


def test_lines_leave_out_missing_parts(values):
    rows = [("RUA", "A", 7), ("RUA", None, 7), (None, None, None)]
    got = values(rows, "t string, s string, n int", fn.address_line(F.col("t"), F.col("s"), F.col("n")))
    assert got == ["RUA A 7", "RUA 7", ""]
    got = values([("LONDRINA", "PR"), (None, "PR")], "c string, s string", fn.place_line(F.col("c"), F.col("s")))
    assert got == ["LONDRINA - PR", "PR"]


def test_search_key_and_its_name(values):
    key = fn.search_key(F.col("n"), F.col("c"), F.col("s"))
    rows = [("LOJA", "LONDRINA", "PR"), ("LOJA, FILIAL", "LONDRINA", "PR"), ("LOJA", None, "PR")]
    schema = "n string, c string, s string"
    assert values(rows, schema, key) == ["LOJA, LONDRINA - PR", "LOJA, FILIAL, LONDRINA - PR", None]
    assert values(rows, schema, fn.search_name(key)) == ["LOJA", "LOJA", None]


def test_label_code(values):
    codes = [0, 1, 2, 3, 5, None]
    got = values(codes, "c short", fn.label_code(F.col("c"), fn.COMPANY_SIZES))
    assert got == [
        "MICROEMPREENDEDOR INDIVIDUAL (MEI)",
        "MICRO EMPRESA (ME)",
        None,
        "EMPRESA DE PEQUENO PORTE (EPP)",
        "DEMAIS",
        None,
    ]
    got = values(codes, "c short", fn.label_code(F.col("c"), fn.REVENUE_BANDS))
    assert got == ["ATÉ 81 MIL", "ATÉ 360 MIL", None, "360 MIL - 4,8 MILHOES", "MAIS DE 4,8 MILHOES", None]
    assert values([1], "c int", fn.label_code(F.col("c"), {})) == [None]


def test_label_code_compares_as_doubles_do(values):
    got = values([1.0, 3.0, 2.5], "c double", fn.label_code(F.col("c"), fn.COMPANY_SIZES))
    assert got == ["MICRO EMPRESA (ME)", "EMPRESA DE PEQUENO PORTE (EPP)", None]


def test_partner_kind_and_age(values):
    got = values([1, 2, 3, 4, None], "c short", fn.label_code(F.col("c"), fn.PARTNER_KINDS))
    assert got == ["PESSOA JURIDICA", "PESSOA FISICA", "ESTRANGEIRO", None, None]
    got = values(list(range(11)), "c short", fn.label_code(F.col("c"), fn.AGE_BANDS))
    tens = [f"{a} - {a + 9} ANOS" for a in range(21, 80, 10)]
    assert got == ["NÃO SE APLICA", "0 - 12 ANOS", "13 - 20 ANOS", *tens, "MAIS DE 80 ANOS", None]


def test_parse_date_never_raises(values):
    texts = ["20200229", None, "-", "", "0", "00000000", "20200230", "2020", "abc", "20201301"]
    assert values(texts, "t string", fn.parse_date(F.col("t"))) == [D(2020, 2, 29)] + [None] * 9


def test_year_and_month(values):
    day = fn.parse_date(F.col("t"))
    assert values(["18900131", "-"], "t string", fn.year_of(day)) == [1890, None]
    assert values(["18900131", "-"], "t string", fn.month_of(day)) == [1, None]


def test_floor_date(values):
    days = [D(1850, 1, 1), D(1900, 1, 1), D(1900, 1, 2), None]
    assert values(days, "d date", fn.floor_date(F.col("d"))) == [D(1900, 1, 1), D(1900, 1, 1), D(1900, 1, 2), None]
    assert values(days, "d date", fn.floor_date(F.col("d"), mode="null")) == [None, None, D(1900, 1, 2), None]
    with pytest.raises(ValueError):
        fn.floor_date(F.col("d"), mode="other")




def test_each_rule_repairs_its_damage_and_leaves_the_sound_word(spark):
    for rules in (fn.STREET_TYPE_RULES, fn.LEGAL_NATURE_RULES, fn.QUALIFICATION_RULES, fn.COUNTRY_RULES):
        rows = [(r.damaged, r.right) for r in rules]
        df = spark.createDataFrame(rows, "damaged string, sound string")
        once = fn.repair_text(F.col("damaged"), rules)
        bad = df.select("*", once.alias("a"), fn.repair_text(F.col("sound"), rules).alias("b"),
                        fn.repair_text(once, rules).alias("c"))
        assert bad.where("a != sound or b != sound or c != sound").collect() == []


def test_rules_spare_words_that_contain_the_damage(values):
    words = ["CORREA", "AREA", "�REA VERDE"]
    assert values(words, "t string", fn.repair_text(F.col("t"), fn.STREET_TYPE_RULES)) == [
        "CORREA", "AREA", "AREA VERDE"]
    words = ["Cargo", "�rg�o P�blico", "Comite", "Comit�", "Servi�os", "Comitiva"]
    assert values(words, "t string", fn.repair_text(F.col("t"), fn.LEGAL_NATURE_RULES)) == [
        "Cargo", "Orgao Publico", "Comite", "Comite", "Servicos", "Comitiva"]
    words = ["nan", "Financeiro", "S�cio Comandit�rio", "N�o informada", "Ind�stria"]
    assert values(words, "t string", fn.repair_text(F.col("t"), fn.QUALIFICATION_RULES)) == [
        "NAO INFORMADO", "Financeiro", "SOCIO COMANDITARIO", "NAO INFORMADO", "INDUSTRIA"]


def test_sound_and_damaged_text_arrive_at_one_spelling(values):
    street = fn.clean_text(F.col("t"), fn.STREET_TYPE_RULES)
    words = ["ÁREA", "AREA", "PRAÇA", "PRA�A", "SÍTIO", "S�TIO", "ESTAÇÃO", "ESTA��O", None]
    assert values(words, "t string", street) == [
        "AREA", "AREA", "PRACA", "PRACA", "SITIO", "SITIO", "ESTACAO", "ESTACAO", None]
    nature = F.upper(fn.clean_text(F.col("t"), fn.LEGAL_NATURE_RULES))
    words = ["Órgão Público", "�rg�o P�blico", "Fundação", "Funda��o", "Município", "Munic�pio"]
    assert values(words, "t string", nature) == [
        "ORGAO PUBLICO", "ORGAO PUBLICO", "FUNDACAO", "FUNDACAO", "MUNICIPIO", "MUNICIPIO"]
    kind = F.upper(fn.clean_text(F.col("t"), fn.QUALIFICATION_RULES))
    words = ["Sócio", "S�cio", "Não informada", "N�o informada", "nan", "Pessoa Física", "pessoa jur�dica"]
    assert values(words, "t string", kind) == [
        "SOCIO", "SOCIO", "NAO INFORMADO", "NAO INFORMADO", "NAO INFORMADO", "PESSOA FISICA", "PESSOA JURIDICA"]


def test_fold_accents_covers_every_latin_letter_with_a_mark(values):
    import unicodedata

    letters = "".join(map(chr, range(0x20, 0x180))).replace("ß", "")
    marked = "ȩ́ ok"
    want = ["".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))
            for t in (letters, marked)]
    assert values([letters, marked, "ß plain", "plain"], "t string", fn.fold_accents(F.col("t"))) == [
        *want, "ss plain", "plain"]


def test_repair_treats_pattern_characters_literally(values):
    rules = [fn.Repair("a.b", "c$1"), fn.Repair("x+y", r"\z$", "word")]
    assert values(["a.b axb x+y xxy"], "t string", fn.repair_text(F.col("t"), rules)) == [r"c$1 axb \z$ xxy"]


def test_unescape_entities_once(values):
    texts = ["a &amp; b", "&amp;lt;", "&#233;&#xE9;&#Xe9;&eacute;", "x&y; & &bogus; &#0; &#xD800; &#9999999;", "", None,
             "&#128512;", "&quot;&lt;&gt;&nbsp;"]
    assert values(texts, "t string", fn.unescape_entities(F.col("t"))) == [
        "a & b", "&lt;", "éééé", "x&y; & &bogus; &#0; &#xD800; &#9999999;", "", None, "😀", '"<>\xa0']


def test_strip_tags(values):
    html = "<b>a</b><!-- > x --> b<script>if (a<b) {}</script><style>\np{}</style>\n<i\nclass='x'>c</i> &amp; d"
    assert values([html], "t string", fn.strip_tags(F.col("t"))) == ["a b\nc & d"]


def block(link=None, text=None, extra=""):
    a = f'<a jsname="x" href="{link}"><h3>t</h3></a>' if link else ""
    d = f'<div class="VwiC3b yXK7lf MUxGbd yDYNvb lyLwlc lEBKkf"><span>{text}</span></div>' if text else ""
    return f'<div class="MjjYud"><div class="g"><div>{a}</div>{d}{extra}</div></div>\n'


def page(*blocks, phones=()):
    side = "".join(f'<span class="LrzXr zdqRlf kno-fv"><a>{p}</a></span>' for p in phones)
    return f'<html><div id="rso">{"".join(blocks)}</div><div id="rhs">{side}</div></html>'


def test_results_of_a_search_page(values):
    html = [
        page(block("http://a/?x=1&amp;y=2", "um <em>dois</em>\ntr&ecirc;s"), block("http://b", "quatro"), block("http://c", "z")),
        page(block("http://a"), block(None, "sem link"), block("http://c", "z")),
        page(),
        page(block("http://only", "one")),
        None,
    ]
    got = values(html, "h string", fn.extract_results(F.col("h"), fn.SEARCH_PAGE))
    assert [[tuple(r) for r in page] if page is not None else None for page in got] == [
        [(0, "http://a/?x=1&y=2", "um dois\ntrês"), (1, "http://b", "quatro")],
        [(0, "http://a", None), (1, None, "sem link")],
        [],
        [],
        None,
    ]
    got = values(html[:1], "h string", fn.extract_results(F.col("h"), fn.SEARCH_PAGE, drop_last=False))
    assert [r["link"] for r in got[0]] == ["http://a/?x=1&y=2", "http://b", "http://c"]


def test_phone_of_a_search_page(values):
    html = [page(block("http://a", "x"), phones=["(43) 3333-1111", "(43) 2"]), page(block("http://a", "x")), None]
    got = values(html, "h string", fn.extract_phone(F.col("h"), fn.SEARCH_PAGE.phone, element=fn.SEARCH_PAGE.phone_element))
    assert got == ["(43) 3333-1111", fn.NO_PHONE, fn.NO_PHONE]


def test_links_in_page_order(values):
    html = '<a class="x" href="/2">b</a><a\nhref="/1?a&amp;b">a</a><a name="x">none</a><a data-href="/no" href="/3">c</a>'
    assert values([html, ""], "h string", fn.extract_links(F.col("h"))) == [["/2", "/1?a&b", "/3"], []]


def test_long_pages_are_read_whole(values):
    html = page(*[block(f"http://x/{i}", f"texto {i} " + "palavra " * 50) for i in range(2000)], phones=["1"])
    got = values([html], "h string", fn.extract_results(F.col("h"), fn.SEARCH_PAGE))[0]
    assert len(got) == 1999 and got[-1]["link"] == "http://x/1998"
    assert values([html], "h string", fn.extract_phone(F.col("h"), fn.SEARCH_PAGE.phone, element=fn.SEARCH_PAGE.phone_element)) == ["1"]
