import pytest

from mentionmill.llm import canonical as M
from mentionmill.llm import confusables as U
from mentionmill.llm import leakage as L
from mentionmill.llm import sentences as S
from mentionmill.llm.queries import QUALIFIERS


@pytest.mark.parametrize(
    ("text", "same"),
    [
        ("ＷＭＬＰ３", "WMLP3"), ("PJΑ12", "PJA12"), ("TМТC1", "TMTC1"), ("B﻿LDL2", "BLDL2"), ("kinase 2", "kinase 2"), (" x ", "x"), ("CXVW‐α", "CXVW-α"),
        ("über", "über"), ("WMPS-ß", "WMPS-β"), ("ﬆomach", "stomach"), ("Kelvin", "Kelvin"), ("mïn", "mïn"), ("ѕї", "sï"), ("so­ft", "soft"),
    ],
)
def test_same_look_same_form(text, same):
    assert U.canonical(text) == same


@pytest.mark.parametrize("text", ["abc", "ABC", "a-b", "a b", "αβγ", "", "опухоль"])
def test_what_is_stable_stays_apart(text):
    assert U.canonical(U.canonical(text)) == U.canonical(text)
    assert U.canonical("abc") != U.canonical("ABC") and U.canonical("a-b") != U.canonical("a b")


def test_composed_and_decomposed_forms_agree_for_all_characters():
    import unicodedata

    every = [chr(o) for o in range(0x110000) if not 0xD800 <= o < 0xE000 and not 0xE0200 <= o]
    assert [c for c in every if U.canonical("a" + c + "b") != U.canonical("a" + unicodedata.normalize("NFD", c) + "b")] == []
    assert U.canonical(unicodedata.normalize("NFD", "한글 কো தொ")) == "한글 কো தொ"


@pytest.mark.parametrize(("text", "same"), [("ᏢTEN", "PTEN"), ("ꓔP53", "TP53"), ("ѡ ᴢ", "w z"), ("Straße, Größe", "Straße, Größe"), ("TGFß1 ß", "TGFβ1 β"), ("a​́", "á"), ("x͏y", "xy")])
def test_more_lookalikes(text, same):
    assert U.canonical(text) == same


def test_lookalikes_from_a_file(tmp_path):
    p = tmp_path / "table.txt"
    p.write_text("﻿# comment\n\n0461 ; 0077 ; MA # x\n10428 ; 006F ; MA\n0031 ; 006C ; MA\n03B1 ; 0061 ; MA\n0041 0301 ; 00C1 ; MA\n33C2 ; 0061 006D ; MA\n", encoding="utf-8")
    f = U.Form(U.read_lookalikes(str(p)))
    assert f.of("ѡ𐐨1αА") == "wo1αA" and U.canonical("𐐨") == "𐐨"


def test_forms_are_computed_once(spark):
    names = spark.createDataFrame([("GENETIC", "TMTC1")], "kind string, name string")
    texts = spark.createDataFrame([("GENETIC", "ТMTC1")], "kind string, text string")
    plan = U.looks_like(texts, names)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2  # one for the texts, one for the names


def test_looks_like(spark):
    names = spark.createDataFrame([("GENETIC", "TMTC1"), ("DISEASE", "TMTC1"), ("GENETIC", None), ("GENETIC", "x")], "kind string, name string")
    rows = [(1, "GENETIC", "ТMTC1"), (2, "GENETIC", "TMTC1"), (3, "GENETIC", "tmtc1"), (4, "CHEMICAL", "ТMTC1"), (5, "GENETIC", None), (6, "GENETIC", "​"), (7, None, "ТMTC1"), (8, "GENETIC", "TMTC1 "), (8, "GENETIC", "TMTC1 "), (9, "GENETIC", "é" * 100_000)]
    texts = spark.createDataFrame([(*r, "n", "f") for r in rows], "k int, kind string, text string, name string, _form string")
    assert sorted((r.k, r.plain, r["name"]) for r in U.looks_like(texts, names).collect()) == [(1, "TMTC1", "n"), (8, "TMTC1", "n"), (8, "TMTC1", "n")]
    assert U.looks_like(texts.limit(0), names).count() == 0 and U.looks_like(texts, names.limit(0)).count() == 0


def test_looks_like_an_unstable_listed_name(spark):
    names = spark.createDataFrame([("GENETIC", "ＴＭＴＣ１")], "kind string, name string")
    texts = spark.createDataFrame([("GENETIC", "TMTC1")], "kind string, text string")
    assert [r.plain for r in U.looks_like(texts, names).collect()] == ["ＴＭＴＣ１"]


NAMES = [
    ("GENETIC", "H1", "TMTC1", 0, False), ("GENETIC", "H1", "tumotcein receptor 1", 3, False), ("GENETIC", "H1", "TMTC-α", 1, False), ("GENETIC", "H2", "TMTC2", 0, False), ("GENETIC", "H2", "tumotcein ligase 1", 3, False),
    ("DISEASE", "M1", "Monfüni disease", 0, False), ("DISEASE", "M2", "wartokroic liver fibrosis", 0, False), ("DISEASE", "M3", "nuvmeseic pancreas edema", 0, False), ("DISEASE", "M4", "oldmonic skin edema", 0, True),
    ("DISEASE", "M5", "breast cancer", 0, False), ("DISEASE", "M6", "lung cancer", 0, False), ("GENETIC", "H3", "breast", 0, False), ("GENETIC", "H3", "TMTC-A", 1, False), ("CHEMICAL", "C4", "diplatin", 0, False),
    ("CHEMICAL", "C1", "lalfastivoxin", 0, False), ("CHEMICAL", "C2", "GV-7850", 1, False), ("CHEMICAL", "C3", "bixlor sulfate", 0, False),
]
MEANT = [
    ("GENETIC", "TMTC1", "H1"), ("GENETIC", "tmtc1", "H1"), ("GENETIC", "TMTC - 1", "H1"), ("GENETIC", "ТMTC1", "H1"), ("GENETIC", "mutant TMTC1", "H1"), ("GENETIC", "anti-TMTC2", "H2"), ("GENETIC", "TMTC1 mRNA", "H1"),
    ("GENETIC", "tmtc alpha", "H1"), ("GENETIC", "tumotcein receptro 1", "H1"), ("GENETIC", "tmtc1 (tumotcein receptor 1)", "H1"), ("GENETIC", "TMTC3", None), ("GENETIC", "TMTX1", None), ("GENETIC", "TMTX-α", None),
    ("GENETIC", "tumotcein receptor 2", None), ("GENETIC", "tumotcein kinase 1", None), ("GENETIC", "tmtc1 (tumotcein receptor 2)", None),
    ("DISEASE", "Monfuni disese", "M1"), ("DISEASE", "Monfüni diseases", "M1"), ("DISEASE", "fibrosis of the liver, wartokroic", "M2"), ("DISEASE", "wartokroic lung fibrosis", None), ("DISEASE", "nuvmeseic pancreas oedema (NOS)", "M3"),
    ("DISEASE", "oldmonic skin edema", None), ("DISEASE", "oldmonic skin edma", None), ("DISEASE", "TMTC1", None),
    ("CHEMICAL", "lalfasitvoxin", "C1"), ("CHEMICAL", "GV 7850", "C2"), ("CHEMICAL", "GV-7851", None), ("CHEMICAL", "lalfastivoxin (oral)", "C1"), ("CHEMICAL", "bixlor", None), ("CHEMICAL", "bixlor sulphate", "C3"),
    ("DISEASE", "brest cancer", "M5"), ("DISEASE", "lugn cancer", "M6"), ("DISEASE", "Lung Cancr", "M6"), ("DISEASE", "brest cncer", "M5"), ("DISEASE", "brst cncer", None), ("GENETIC", "brust", None), ("GENETIC", "TMTB-A", None), ("GENETIC", "tmtb a", None),
    ("CHEMICAL", "lalfstivxin", "C1"), ("CHEMICAL", "dplatin", "C4"), ("CHEMICAL", None, None), ("CHEMICAL", "", None), (None, "TMTC1", None), ("CHEMICAL", "x" * 50_000, None),
]


@pytest.mark.parametrize("block", [3, 50_000])
def test_closest_entries(spark, block):
    names = spark.createDataFrame([(k, i, n, f, b) for k, i, n, f, b in NAMES], "kind string, ref_id string, name string, field_rank int, blocked boolean")
    values = spark.createDataFrame([(i, k, t, "clash") for i, (k, t, _) in enumerate(MEANT)], "id int, kind string, text string, name string")
    got = {r.id: r.ref_id for r in M.closest_entries(values, ["id"], names, rules=QUALIFIERS, max_names=block).collect()}
    assert got == {i: e or M.UNMATCHED for i, (_, _, e) in enumerate(MEANT)}


def test_closest_entries_of_nothing(spark):
    names = spark.createDataFrame([], "kind string, ref_id string, name string, field_rank int, blocked boolean")
    values = spark.createDataFrame([(1, "GENETIC", "a")], "id int, kind string, text string")
    assert [r.ref_id for r in M.closest_entries(values, ["id"], names).collect()] == [M.UNMATCHED]
    assert M.closest_entries(values.limit(0), ["id"], names).count() == 0


def test_frequency_decides_ties(spark):
    names = spark.createDataFrame([("GENETIC", i, "shared alias", 1, False) for i in ("H1", "H2")], "kind string, ref_id string, name string, field_rank int, blocked boolean")
    values = spark.createDataFrame([(1, "GENETIC", "shared alias")], "id int, kind string, text string")
    often = spark.createDataFrame([("H2", 5), ("H1", 2)], "ref_id string, n long")
    assert [r.ref_id for r in M.closest_entries(values, ["id"], names, often).collect()] == ["H2"]
    assert [r.ref_id for r in M.closest_entries(values, ["id"], names).collect()] == ["H1"]


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ZH = "在编号为三五六零的试验组中不均匀反应在更换蜡样培养液之后消失残余物重量"


def _leaks(spark, docs, items=((1, "en", ITEM), (2, "zh", ZH))):
    d = spark.createDataFrame([(i, t, 7) for i, t in enumerate(docs)], "doc_id long, text string, item_id int")
    return sorted(tuple(r) for r in L.leaks(d, "doc_id", "text", spark.createDataFrame(list(items), "item_id long, lang string, text string"), "item_id", "lang", "text").collect())


def test_leaks(spark):
    w = ITEM.split()
    docs = [
        "x " + " ".join(w[:12]) + " y", "x " + " ".join(w[:11]) + " y", "A. " + ", ".join(w[1:13]).upper() + "!", " ".join(w[:5]) + " thi-\nrteen " + " ".join(w[5:]), " ".join(w[:5]) + " s-\nix " + "\n".join(w[6:]),
        "ｏｎｅ " + " ".join(w[1:]), "", None, ZH[:24], ZH[:23], "，".join(ZH[3:30]), ITEM + " " + ITEM, "one two " * 5000, "x" * 200_000,
    ]
    assert _leaks(spark, docs) == [(0, 1), (2, 1), (4, 1), (5, 1), (8, 2), (10, 2), (11, 1)]


def test_leaks_of_nothing(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, None, ITEM), (2, "en", None), (3, "en", "")], "item_id long, lang string, text string")
    assert L.leaks(d, "doc_id", "text", items, "item_id", "lang", "text").count() == 0
    assert L.leaks(d, "doc_id", "text", items.limit(0), "item_id", "lang", "text").count() == 0


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    items = [(i, "en", " ".join(f"w{i}x{k}" for k in range(14))) for i in range(6)]
    docs = ["a " + t + " b" for _, _, t in items]
    want = [(i, i) for i in range(6)]
    assert _leaks(spark, docs, items) == want
    monkeypatch.setattr(L, "MAX_UNITS", 100)
    monkeypatch.setattr(L, "HELD", 2)
    assert _leaks(spark, docs, items) == want
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    of = lambda: L.leaks(d, "doc_id", "text", spark.createDataFrame(items, "item_id long, lang string, text string"), "item_id", "lang", "text")
    passes = lambda: of()._jdf.queryExecution().executedPlan().toString().count("MapInPandas")
    assert passes() == 1  # many blocks, one pass
    monkeypatch.setattr(L, "MAX_SCAN", 250)
    assert _leaks(spark, docs, items) == want and passes() > 1


def test_what_cannot_be_seen_breaks_no_run(spark):
    w = ITEM.split()
    docs = [" ".join(w[:6]) + x + " ".join(w[6:]) for x in (" _ ", "\n___\n", " \u200b ", "_", " \u0301 ", " \u00ad\u2060 ")] + ["_".join(w), " ".join(k[:2] + "\u200d" + k[2:] for k in w)]
    assert _leaks(spark, docs) == [(i, 1) for i in range(len(docs))]
    hindi = "यह एक लंबा वाक्य है जिसमें बारह से अधिक शब्द हैं और कुछ नहीं"
    assert _leaks(spark, [hindi, " ".join(hindi.split()[:11])], [(5, "hi", hindi)]) == [(0, 5)]


def test_leaks_equal_ngram_brute_force(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/eval_items.parquet")
    got = {tuple(r) for r in L.leaks(docs, "doc_id", "text", items, "item_id", "lang", "text").collect()}
    import re

    words = lambda t: [w for w in (L.plain_word(x) for x in re.findall(r"[^\W_]+", re.sub(r"(?<=\w)-\n(?=\w)", "", t))) if w]
    flat = lambda t: L.letters(t, L._Letters())[0]
    grams = {}
    for r in items.collect():
        x, n = (flat(r.text), 24) if r.lang == "zh" else (words(r.text), 12)
        for k in range(len(x) - n + 1):
            grams.setdefault(tuple(x[k : k + n]), set()).add(r.item_id)
    want = set()
    for r in docs.where("text is not null").collect():
        for x, n in ((flat(r.text), 24), (words(r.text), 12)):
            for k in range(len(x) - n + 1):
                want |= {(r.doc_id, i) for i in grams.get(tuple(x[k : k + n]), ())}
    assert got == want and got


@pytest.mark.parametrize(("block", "scan"), [(60, 60), (60, 10_000), (200_000, 8_000_000)])
def test_scrubbed(spark, monkeypatch, block, scan):
    monkeypatch.setattr(L, "MAX_UNITS", block)
    monkeypatch.setattr(L, "MAX_SCAN", scan)
    d = spark.createDataFrame([(1, "keep this. " + ITEM + " and this, which is a good deal longer than what goes, so that it stays, indeed it does", 1), (2, ITEM, 1), (3, "clean", 1), (4, None, 1), (5, ZH[:30] + "。" + "水" * 100, 1)], "doc_id long, text string, runs int")
    items = spark.createDataFrame([(1, "en", ITEM), (2, "en", ITEM), (3, "zh", ZH)], "item_id long, lang string, text string")
    got = {r.doc_id: (r.removed, r.clean, r.dropped) for r in L.scrubbed(d, "doc_id", "text", items, "item_id", "lang", "text").collect()}
    assert set(got) == {1, 2, 5} and got[2] == (len(ITEM), None, True)
    assert got[1][0] == len(ITEM) and got[1][1].startswith("keep this.  and this") and not got[1][2]
    assert got[5] == (30, "。" + "水" * 100, False)


CASES = [
    ["He left.", "She came."],
    ["It fell by 3.5 mL, cf. Fig. 4 (see ref. 2), i.e. less.", "Next."],
    ["Dr. J. Smith of the U.S. came at 5 p.m. and left.", "None stayed in arm B.", "We saw it."],
    ['One asked, "Is it so?" before the run.', 'It said: "No."', "Then it stopped."],
    ['"We saw no change. The run stopped," it says.', "(Data are not shown.)", "Fine.[3]", "Last"],
    ["The effect was lost ... but it returned.", "It is unclear…", "Why?!", "Stop!"],
    ["Am 3. Mai kam die 2. Gruppe, z. B. Wasser, usw.", "Die Werte lagen bei 9,2 mg, d. h. tief.", "Es stand: „Es ist zu meiden.“", "„Nichts. Dann Ende“, heißt es."],
    ["« Rien n'a changé. C'est fini », dit-il.", "Env. 88 % des cas, c.-à-d. peu.", "Il conclut : « C'est à éviter. »", "M. Yostrel lit."],
    ["«No hubo cambios. Fin», dice.", "¡Se detuvo!", "¿Por qué?", "Vive en EE. UU. durante 3 meses."],
    ["It was held in the arm.", "alpha-PVFR5 was not detected.", "The dose was 5 mM.", "p43-like signals were absent, e.g. p53.", "None were under 18 yr.", "p9-like signals rose."],
    ["It left a residue of a.", "Growth stopped.", 'It said: "No."', "mTOR rose."],
    ["В 2011 г. было собрано, т. е. взято.", "Вода, соль и т. д.", "Рост прекратился!", "«Нет. Конец», — сказано."],
    ["डॉ. वेलमा ने 3 मि.ग्रा. दिया।", "क्या हुआ?"],
    ["فحص د. فيلما 19 عينة، ثم سجل.", "هل هو؟", "سأل: «هل هو؟» ثم أعاد."],
]


@pytest.mark.parametrize("parts", CASES)
def test_sentences_of_spaced_scripts(parts):
    text = " ".join(parts)
    assert [text[a:b] for a, b in S.split(text)] == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["报告写道：“不应混用。”", "finusstutic carcinoma患者接受了水。", "kenan降低了水平。"],
        ["“没有变化。实验随后停止。”报告如此写道。", "报告写道：“不应混用。”", "剂量为5.3毫克；结果稳定。", "研究者问道：“是否必要？”随后重复了实验。", "效果消失……但37天后恢复。"],
        ["「変化はない。終了した。」と報告書は記す。", "v2.26の手順に従い調べた。", "「必要か？」という問いが残る。", "止まった！"],
    ],
)
def test_sentences_of_han_and_kana(parts):
    text = "".join(parts)
    assert [text[a:b] for a, b in S.split(text)] == parts


def test_sentences_of_thai():
    parts = ["การขาดยีน PXZV2 ทำให้เซลล์หยุดแบ่งตัว", "ไม่พบความแตกต่างระหว่างสองกลุ่ม", "สาร lalfa ไม่มีผลต่อการเติบโตของเซลล์", "ระดับเฉลี่ยเท่ากับ 2.5 มิลลิกรัมซึ่งต่ำกว่าเกณฑ์"]
    text = " ".join(parts)
    assert [text[a:b] for a, b in S.split(text)] == parts
    assert S.thai_words("ไม่พบความแตกต่าง") == ["ไม่", "พบ", "ความ", "แตกต่าง"]


@pytest.mark.parametrize(
    "parts",
    [
        ["ไม่พบความแตกต่างระหว่างสองกลุ่ม", "PXZV2 ทำให้เซลล์หยุดแบ่งตัว"],
        ["การขาดยีน PXZV2 ทำให้เซลล์ตาย", "β-catenin ลดลงในกลุ่มทดลอง"],
        ["การเติบโตของเซลล์ถูกยับยั้งโดย PXZV2", "ผู้วิจัยตรวจตัวอย่างทั้งหมด 6 ครั้งก่อนสรุปผล"],
        ["ระดับเฉลี่ยเท่ากับ 2.5", "การขาดยีน PXZV2 ทำให้เซลล์หยุดแบ่งตัว"],
        ["ผู้ป่วยได้รับยา (aspirin)", "ผลการทดลองคงที่ตลอดช่วงเวลาที่ศึกษา"],
        ["ผู้ป่วยได้รับยาแล้วครับ", "12 คนหายดี"],
        ["การแสดงออกของยีน MLPK4 เพิ่มขึ้นอย่างชัดเจนในกลุ่มทดลอง"],
        ["ผู้ป่วยโรค hatfitdexic lung anemia ได้รับยาทุกวันตามแผน"],
        ["ผู้ป่วยได้รับยา aspirin ทุกวันตามแผน"],
        ["พบว่า ABC1 ระดับสูงในกลุ่มทดลอง"],
        ["ผู้วิจัยตรวจ 6 ตัวอย่างก่อนสรุปผล (PXZV2)"],
    ],
)
def test_thai_gaps_next_to_names_and_numbers(parts):
    text = " ".join(parts)
    assert [text[a:b] for a, b in S.split(text)] == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["The value at 5 MM.", "Then we left."], ["MM. Dupont et Durand sont venus."], ["He lives in the U.S. Army base."], ["They moved to the U.S.", "Nobody followed."],
        ["Plan B.", "Then go."], ["J. R. Hartley wrote it.", "It sold well."], ["We met Prof. Ng, M.D., at noon.", "She nodded."], ["Is it true?", "yes, it is.", "Good!"],
        ["Version 2.1.3 is out.", "Update now."], ["He asked \"Why?\" and left.", "(No one knew.)", "So it goes."], ["Costs rose by $3.5 million, approx. 4 %.", "Wages fell."], ["1. Mix.", "2. Stir."],
        ["Er kam am 3. Mai um 5 Uhr.", "Wir gingen."], ["Voir p. 12 et fig. 3.", "C'est clair."], ["¿Qué hora es?", "Son las 3 p. m. en punto."],
    ],
)
def test_sentences_of_other_phrasing(parts):
    text = "\n".join(parts) if parts[0] == "1. Mix." else " ".join(parts)
    assert [text[a:b] for a, b in S.split(text)] == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["これはペンです", "それは本です"], ["我们昨天到了", "他们今天走了"], ["昨日は雨だった", "しかし 今日は晴れです"], ["ฉันไปตลาดแล้ว", "เราซื้อผลไม้มาก"], ["เขาบอกว่า ไม่มีเวลา"],
        ["ខ្ញុំទៅផ្សារហើយ", "គាត់នៅផ្ទះ"], ["ខ្ញុំទៅផ្សារ។", "គាត់នៅផ្ទះ។"], ["ຂ້ອຍກິນເຂົ້າແລ້ວ", "ເຂົາໄປຕະຫຼາດ"], ["သူသွားသည်။", "ကျွန်တော်လာသည်။"], ["သူသွားသည်", "ကျွန်တော်လာသည်"], ["研究结果 和 方法"],
    ],
)
def test_gaps_of_scripts_without_blanks(parts):
    text = " ".join(parts)
    assert [text[a:b] for a, b in S.split(text)] == parts


def test_a_dictionary_given():
    more = S._with_words(["ตลาดน้ำ", "ペン"])
    assert more["thai"].cut("ไปตลาดน้ำ") == ("ไป", "ตลาดน้ำ") and "ペン" in more["han"].words and "ペン" not in more["thai"].words


def test_best_path_is_the_best_of_all_paths():
    import random

    rng = random.Random(5)
    for _ in range(300):
        at = sorted(rng.sample(range(1, 60), rng.randint(1, 7)))
        nodes = [(p, p, p + rng.randint(0, 4), rng.uniform(-3, 3), [(rng.randint(0, p), rng.uniform(-4, 4)) for _ in range(rng.randint(0, 2))]) for p in at]
        top = 0
        nodes = [(p, e, top := max(top, n), g, x) for p, e, n, g, x in nodes] + [(70, 70, 70, 0.0, [])]

        def worth(chosen):
            start, total = 0, 0.0
            for k in chosen:
                p, _, n, g, x = nodes[k]
                if p < start:
                    return -1e9
                total += g + sum(d for q, d in x if start >= q)
                start = n
            return total

        last = len(nodes) - 1
        best = max((worth([k for k in range(last) if bits >> k & 1] + [last]) for bits in range(1 << last)))
        ends = [e for _, e in S.best_path(nodes, 0)]
        place = {n[1]: k for k, n in enumerate(nodes)}
        assert worth([place[e] for e in ends]) == pytest.approx(best)


def test_long_blocks_take_linear_time():
    import time

    start = time.time()
    for text in ("Mr. X (a. b) said. " * 20_000, "การ ยา " * 20_000, ". " * 60_000, "a." * 50_000, "「あ。」と。" * 20_000, "1. x\n" * 20_000):
        S.split(text)
    assert time.time() - start < 60


def test_lines_headings_and_lists():
    text = "Main findings\n\nThe effect\nwas\nlost.The next held.\n\n1. Wash it.\n2. Add 3 mL\nof it.\n"
    assert [text[a:b] for a, b in S.split(text)] == ["Main findings", "The effect\nwas\nlost.", "The next held.", "1. Wash it.", "2. Add 3 mL\nof it."]


@pytest.mark.parametrize("text", ["", " \n\n ", "​", "(((((" * 9000, '"' * 9001, ". " * 9000, "«" * 5000 + "»" * 5000, "x" * 300_000, "\n" * 9000, "ก" * 20_000])
def test_odd_texts_are_covered_once(text):
    spans = S.split(text)
    assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    seen = "".join(text[a:b] for a, b in spans)
    assert "".join(seen.split()) == "".join(text.replace("​", "").split())


def test_every_document_is_covered(spark, sf):
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").where("text is not null").collect():
        spans = S.split(r.text)
        assert "".join("".join(r.text[a:b] for a, b in spans).split()).replace("​", "") == "".join(r.text.split()).replace("​", "")


def test_sentences_table(spark):
    d = spark.createDataFrame([(1, "Ab cd. Ef gh.", 0), (1, "Ab cd. Ef gh.", 0), (2, None, 0), (3, "", 0)], "doc_id long, text string, start_pos int")
    assert sorted(tuple(r) for r in S.sentences(d, "doc_id", "text").collect()) == [(1, 0, 6), (1, 0, 6), (1, 7, 13), (1, 7, 13)]
    assert S.sentences(d.limit(0), "doc_id", "text").count() == 0
