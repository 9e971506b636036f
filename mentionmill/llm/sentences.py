"""Sentence boundaries across languages and scripts.

Every text between blank lines is a lattice of terminators: end marks, closes of quotations and brackets, and, in scripts without
blanks between words, the gaps. Each has two readings, end and inside. Evidence around it adds up to log odds for the end (what the
marks are, what word stands before, what follows, how it is set), and evidence that depends on where the sentence began counts by
that: a number that opens a sentence is a list number, a bracket that opens one is a text of its own, a clause without a predicate or
a stretch without a letter is no sentence. The readings of a block are those of the lattice's best path, found exactly. Headings and
list items are forced.

Scripts without blanks between words (Thai, Lao, Khmer, Burmese, Han, kana) are cut into words by the cheapest path through the
lattice of a dictionary's words; gaps are then classed by what ends before them (final particles, words that lead on) and what opens
behind them (opening words, words that run on). The words built in are the frequent and the deciding ones; ``words`` adds a full
dictionary.

End marks inside a quotation or bracket only count at its close. Line ends count as blanks, except around blank lines, headings
and list items. Rules look at the text itself, never at a language column, so mixed documents work.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionmill.session import ship

# Fixed values, lower case. Abbreviations behind which a sentence always runs on.
ABBREVIATIONS = frozenset(
    "chr suppl est cf fig figs eq eqs ref refs vs approx no nos dr drs mr mrs ms prof st e.g i.e viz resp ca tab vol p pp sec ch art ed eds dept "
    "z.b u.a d.h i.d.r vgl abb bzw evtl ggf inkl nr o.ä s.o s.u med bsp zzt sog "
    "m mme mlle env p.ex c.-à-d chap art "
    "ee sr sra srta dra ud uds p.ej aprox pág núm "
    "рис табл см т.е проф др-р акад стр напр гл "
    "डॉ सं श्री मि.ग्रा मि.ली कि.ग्रा प्रो द.म".split()
)
#: Abbreviations that end a sentence if what follows looks like a beginning.
EITHER = frozenset("al etc min sec max hr hrs yr yrs wk mo vol inc ltd co corp u.s u.k e.u u.n a.m p.m ph.d usw std u.s.w etw ff др т.д т.п г гг в.в uu dgl म.प्र".split())
#: Words before a number with a point that is an ordinal (German) and runs on.
ORDINAL_BEFORE = frozenset("am der die das dem den des im vom zum zur seit bis ab beim ein eine einer einem".split())
#: Words that open a clause which runs on behind a closed quotation or a pause, in scripts without case.
RUNS_ON = {
    "han": ("随后", "然后", "之后", "接着", "并", "但", "而", "又", "也", "再", "的", "等", "这", "一", "是", "却", "仍", "后", "于是", "因此", "所以", "と", "という", "って", "を", "は", "が", "に", "の", "で", "も", "へ", "や", "など", "しかし", "ただし", "だが"),
    "dev": ("और", "तथा", "या", "लेकिन", "पर", "फिर", "तो", "कि", "यह", "ऐसा", "कहा", "पूछा", "जैसे"),
    "arab": ("ثم", "و", "لكن", "أو", "ف", "قال", "حسب", "كما"),
    "thai": ("และ", "หรือ", "แต่", "ที่", "ซึ่ง", "โดย", "เพื่อ", "เพราะ", "จึง", "แล้ว", "กับ", "ของ", "ใน", "จาก", "ว่า", "ได้", "ให้", "มี", "เป็น", "คือ", "ถึง", "ด้วย", "ต่อ", "ก็", "จน", "เมื่อ", "ๆ", "ฯ", "ครั้ง", "มิลลิกรัม", "เปอร์เซ็นต์"),
}
#: Fixed values, lower case: nouns that a single capital letter labels, so that a point behind the letter may end a sentence.
LABELLED = frozenset("plan arm arms group groups panel type plate site vitamin hepatitis cohort ward lane phase class grade stage part series form factor strain kit lot batch level sample set tube well chamber chain appendix box step option category gruppe typ arm grupo tipo groupe brazo группа".split())
THAI_OPENING = ("การ", "สาร", "ผู้", "ผล", "ระดับ", "ความ", "กลุ่ม", "ตัวอย่าง", "นักวิจัย", "เซลล์", "ยีน", "โรค", "ไม่พบ", "พบว่า", "จากการ", "ใน", "เรา", "อย่างไรก็ตาม", "นอกจากนี้", "ดังนั้น", "สรุป", "งานวิจัย", "วิธี", "ข้อมูล", "หลังจาก", "ก่อน", "เมื่อ")
THAI_FINAL = ("ครับ", "ค่ะ", "คะ", "นะ", "แล้ว", "เลย", "ไหม", "หรือไม่", "อีก", "เท่านั้น")
THAI_WORDS = (
    "การ แสดงออก ของ ยีน เพิ่มขึ้น ลดลง อย่าง ชัดเจน ใน กลุ่ม ทดลอง ควบคุม สาร ไม่ มี ผล ต่อ เติบโต เซลล์ ผู้ วิจัย ป่วย ตรวจ ตัวอย่าง ทั้งหมด ครั้ง ก่อน สรุป หลัง ขาด ทำให้ หยุด แบ่งตัว "
    "คงที่ ตลอด ช่วง เวลา ที่ ศึกษา ระดับ เฉลี่ย เท่ากับ มิลลิกรัม ซึ่ง ต่ำกว่า สูงกว่า เกณฑ์ พบ ความ แตกต่าง ระหว่าง สอง โรค ได้รับ ยา ทุก วัน ตาม แผน และ หรือ แต่ โดย เพื่อ เพราะ จึง จาก กับ เป็น คือ ถูก จะ ต้อง "
    "ควร อาจ ได้ ให้ ไป มา อยู่ แล้ว ยัง ว่า นี้ นั้น เมื่อ ถ้า หาก ด้วย ถึง วิธี นัก งาน ข้อมูล ครับ ค่ะ คะ นะ เลย ไหม อีก เท่านั้น มาก น้อย กว่า ปี เดือน คน ราย หนึ่ง สาม"
).split()
THAI_MORE = (
    "โปรตีน เอนไซม์ ไวรัส เชื้อ แบคทีเรีย ตัวรับ ตำแหน่ง สายพันธุ์ ชนิด ค่า เทคนิค เครื่อง อาการ เลือด เนื้อเยื่อ มะเร็ง ตับ ปอด หัวใจ หนู สัตว์ มนุษย์ เด็ก ผู้หญิง ผู้ชาย แพทย์ โรงพยาบาล ปริมาณ จำนวน อัตรา ร้อยละ ความเสี่ยง "
    "ยับยั้ง กระตุ้น แสดง แสดงออก เกิด ช่วย ลด เพิ่ม รักษา วิเคราะห์ ใช้ ตรวจพบ สามารถ เกี่ยวข้อง สัมพันธ์ จับ สร้าง ทำงาน ตาย หาย ดีขึ้น แย่ลง สูงขึ้น ต่ำลง ตอบสนอง ควบคุม วัด ให้ผล รายงาน เริ่ม เปลี่ยนแปลง เปลี่ยน "
    "ฉัน เขา เธอ คุณ บ้าน ตลาด ผลไม้ กิน ซื้อ ขาย รู้ เห็น บอก พูด คิด ทำ เดิน อ่าน เขียน ทั้งหมด เช่น แก่ รวมทั้ง ได้แก่ หลังจาก ก่อนหน้านี้ ตาม ภายใน สำหรับ ร่วม ร่วมกับ ปกติ ชัดเจน รุนแรง สำคัญ อย่างมี นัยสำคัญ ทางสถิติ ดี สูง ต่ำ ใหม่ เดิม ที่สุด เสมอ วันนี้ สี่ ห้า หก เจ็ด แปด เก้า สิบ"
).split()
#: Words that say something of a subject, unless a noun is made of them.
THAI_PREDICATES = frozenset(
    "ทำให้ เพิ่มขึ้น ลดลง พบ ตรวจ ตรวจพบ ได้รับ มี เป็น คือ ถูก ไม่ เท่ากับ หยุด คงที่ ต่ำกว่า สูงกว่า จะ ต้อง ควร อาจ ยับยั้ง กระตุ้น แสดง เกิด ช่วย ลด เพิ่ม รักษา วิเคราะห์ ใช้ สามารถ เกี่ยวข้อง สัมพันธ์ จับ สร้าง ทำงาน "
    "ตาย หาย ดีขึ้น แย่ลง สูงขึ้น ต่ำลง ตอบสนอง ควบคุม วัด ให้ผล รายงาน เริ่ม เปลี่ยนแปลง เปลี่ยน สรุป ขาด ศึกษา ไป มา อยู่ กิน ซื้อ ขาย รู้ เห็น บอก พูด คิด ทำ เดิน อ่าน เขียน".split()
)
THAI_MAKES_NOUN = frozenset("การ ความ ผู้ นัก กลุ่ม ที่ ซึ่ง".split())
#: Words that end no clause: a clause runs on behind them.
THAI_LEADS = frozenset("ของ ใน กับ และ หรือ แต่ โดย เพื่อ เพราะ จึง จาก ต่อ ระหว่าง ว่า เช่น ที่ ซึ่ง สำหรับ คือ เป็น จะ ต้อง ควร อาจ ถูก".split())
#: Words before a name or number that belongs to them: a name or number behind them belongs to them. Most verbs and all nouns that names label are among them.
THAI_TAKES = THAI_MAKES_NOUN | frozenset(
    "ยีน สาร โรค ยา เซลล์ โปรตีน เอนไซม์ ไวรัส เชื้อ แบคทีเรีย ตัวรับ ตำแหน่ง สายพันธุ์ ชนิด ค่า เทคนิค เครื่อง วิธี มะเร็ง ระดับ จำนวน ปริมาณ อัตรา ร้อยละ ป่วย ตัวอย่าง ทั้งหมด ของ ใน กับ และ หรือ แต่ โดย เพื่อ เพราะ จึง ด้วย จาก "
    "ต่อ ระหว่าง ว่า เช่น แก่ รวมทั้ง ได้แก่ หลังจาก หลัง ก่อน ตาม ภายใน สำหรับ ร่วม ร่วมกับ ถึง เมื่อ ถ้า หาก กว่า ต่ำกว่า สูงกว่า เท่ากับ คือ เป็น มี พบ ตรวจ ตรวจพบ ใช้ ได้รับ ได้ ให้ ทำให้ ถูก จะ ต้อง ควร อาจ ไม่ ยับยั้ง กระตุ้น "
    "แสดง ช่วย ลด เพิ่ม รักษา วิเคราะห์ สามารถ เกี่ยวข้อง สัมพันธ์ จับ สร้าง ควบคุม วัด ศึกษา ขาด ช่วง เวลา ทุก ปี เดือน วัน อีก".split()
)
THAI_NUMERALS = frozenset("หนึ่ง สอง สาม สี่ ห้า หก เจ็ด แปด เก้า สิบ".split())
#: What opens a sentence behind a name or sign; what also counts or qualifies, so that it needs a predicate in its run; what opens one behind a number.
THAI_AFTER_NAME = ("การ", "ผู้", "ผล", "ไม่พบ", "พบว่า", "จากการ", "นักวิจัย", "เรา", "อย่างไรก็ตาม", "นอกจากนี้", "ดังนั้น", "สรุป", "งานวิจัย", "ข้อมูล")
THAI_AFTER_NAME_IF_SAID = ("ระดับ", "ความ", "กลุ่ม", "ตัวอย่าง", "สาร", "เซลล์", "ยีน", "โรค", "วิธี")
THAI_AFTER_NUMBER = ("การ", "ผู้", "ไม่พบ", "จากการ", "นักวิจัย", "เรา", "อย่างไรก็ตาม", "นอกจากนี้", "ดังนั้น", "สรุปได้", "งานวิจัย")
THAI_POLITE = ("ครับ", "ค่ะ", "นะคะ")

#: Fixed values, lower case: words that often open a sentence of a script with blanks, and seldom belong to a name.
OPENERS = frozenset(
    "the a an this that these those it its we our they he she you in on at by for from with after before during when while if although however moreover thus therefore then here there no none both each all some many most several such "
    "der die das ein eine es wir sie er im am nach bei vor während wenn obwohl jedoch dann hier kein keine beide alle diese dieser dieses "
    "le la les un une il elle ils nous on ce cette ces dans après avant pendant si cependant puis aucun "
    "el los las una se lo en después antes durante sin ningún este esta estos "
    "в на и но он она оно они мы это этот эта эти после до при если однако затем не".split()
)
#: Fixed values, lower case: words that the acronym of a country before them belongs to.
NAMED_BY_COUNTRY = frozenset("army navy senate congress supreme department national government president treasury federal air food centers census public environmental patent geological marine coast security general".split())
#: Fixed values, by script: words that can end a sentence, that open one, that lead on, and other words of the word lattice.
LEXICON = {
    "thai": (THAI_FINAL, THAI_OPENING, (*THAI_LEADS, *RUNS_ON["thai"]), (*THAI_WORDS, *THAI_MORE)),
    "lao": (
        "ແລ້ວ ເດີ ບໍ ເນາະ ແດ່ ເລີຍ".split(), "ຂ້ອຍ ພວກເຮົາ ເຮົາ ລາວ ເຂົາ ພວກເຂົາ ມັນ ການ ຜູ້ ຜົນ ນັກ ດັ່ງນັ້ນ ຫຼັງຈາກ ນີ້".split(),
        "ຂອງ ໃນ ທີ່ ແລະ ຫຼື ກັບ ຈາກ ສຳລັບ ວ່າ ແຕ່ ເພາະ ຊຶ່ງ ໂດຍ".split(), "ແມ່ນ ເປັນ ມີ ໄປ ມາ ກິນ ເຮັດ ເຫັນ ຮູ້ ຢູ່ ໄດ້ ບໍ່ ພົບ ເພີ່ມ ຫຼຸດ ຢາ ໂຣກ ຄົນ ມື້ ປີ".split(),
    ),
    "khmer": (
        "ហើយ ទេ ណា ផង វិញ".split(), "ខ្ញុំ យើង គាត់ នាង ពួកគេ វា ការ អ្នក លទ្ធផល ដូច្នេះ បន្ទាប់ពី នេះ".split(),
        "និង ឬ ដែល របស់ ក្នុង ពី ដើម្បី ប៉ុន្តែ ដោយ ថា".split(), "គឺ ជា មាន ទៅ មក ធ្វើ ឃើញ ដឹង នៅ បាន មិន ថ្នាំ ជំងឺ មនុស្ស ថ្ងៃ ឆ្នាំ".split(),
    ),
    "burmese": (
        "သည် တယ် မယ် ပြီ မည် လား ပါသည် ပါတယ်".split(), "ကျွန်တော် ကျွန်မ သူ ဒါ ဤ ထို သို့သော် ထို့ကြောင့်".split(),
        "နှင့် သို့မဟုတ် က ကို မှာ တွင် ၏ အတွက် သော ပြီး".split(), "ရှိ သွား လာ စား လုပ် မြင် သိ ဆေး ရောဂါ လူ ရက် နှစ် မ".split(),
    ),
    "han": (
        "です ます でした ました ません ますか ですか だった である ない った た だ ね よ か 了 吗 呢 吧 啊 的 过".split(), "これは それは この その しかし また そして 我々は 私 彼 それ これ 我们 他们 她们 我 你 他 她 它 这 那 但是 因此 所以 然而 此外 结果 本研究 研究者".split(),
        "と を は が に の で も へ や から まで より 和 与 或 在 对 把 被 从 向 以 为".split(), "という こと もの する して した いる ある なる れる られる 研究 結果 结果 患者 細胞 细胞 効果 试验 試験 没有 可以 一个".split(),
    ),
}

OPEN, CLOSE = "([{（【〔「『《〈«“„‘‹", ")]}）】〕」』》〉»”“’›"
_PAIR = {"(": ")", "[": "]", "{": "}", "（": "）", "【": "】", "〔": "〕", "「": "」", "『": "』", "《": "》", "〈": "〉", "«": "»", "“": "”", "„": "“”", "‹": "›"}
_QUOTES = "«»“”„‹›「」『』\""
_END = ".!?…。！？．｡؟।॥۔។៕။‼⁇⁈⁉"
_MARKS = re.compile(r"[.!?…。！？｡؟।॥۔។៕။‼⁇⁈⁉]+(?:[ \t]?[.…](?=[ \t]?[.…]))*")
_BRACKETS = re.compile("[" + re.escape("".join(_PAIR) + "".join(dict.fromkeys("".join(_PAIR.values()))) + '"') + "]")
_BLOCK = re.compile(r"[ \t\r 　]*\n(?:[ \t\r 　]*\n)+[\s​﻿]*| ")
_ITEM = re.compile(r"(?:\d{1,3}[.)]|[A-Za-z]\)|[ivxIVX]{1,4}\)|\(\w{1,3}\)|[-*\u2022\u2023\u25e6\u2013\u00b7])\s+(?=\S)")
_CITED = re.compile(r"\[\d+(?:\s*[,;–-]\s*\d+)*\]")
_HAN = re.compile(r"[぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff]")
_SPACELESS = {"thai": "\u0e00-\u0e7f", "lao": "\u0e80-\u0eff", "khmer": "\u1780-\u17d3\u17d7-\u17ff", "burmese": "\u1000-\u1049\u104c-\u109f", "han": "\u3005\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"}
_RUNS = {k: re.compile(f"[{r}]+") for k, r in _SPACELESS.items()}
_PLAIN_GAPS = "".join(r for k, r in _SPACELESS.items() if k != "thai")
_BLANKS = "[ \t\u00a0\u3000\n\r]+"
_THAI_GAP = re.compile(rf"(?<=[\u0e00-\u0e7f]){_BLANKS}(?=[\u0e00-\u0e7f])|(?<=[^\s\u0e00-\u0e7f]){_BLANKS}(?=[\u0e00-\u0e7f])|(?<=[\u0e00-\u0e7f]){_BLANKS}(?=[^\s\u0e00-\u0e7f])")
_GAP = re.compile(rf"(?<=[{_PLAIN_GAPS}]){_BLANKS}(?=[{_PLAIN_GAPS}])")
_NAME = re.compile(r"[^\s,;:()\[\]\"“”«»„.!?…]+")
_PART = re.compile(r"[\s()\[\]{}«»“”„\"'‘’,;:/（）、，；：]")
_WORD_BEFORE = re.compile(r"[^\s()\[\]{}«»“”„\"'‘’,;:/（）、，；：]*$")
#: No listed word is longer; of what stands before a mark, no more needs to be looked at to know that it is none.
_LONGEST_LISTED = 40
#: Abbreviations before a number that are also words.
NUMBERED = frozenset("no nos art sec ch cap".split())
#: Letters that are words of their own in some language.
ONE_LETTER_WORDS = "aeouyаиоуя"
#: Fixed values, lower case: titles that stand on a line of their own above running text.
TITLES = frozenset(
    "abstract background introduction methods results discussion conclusion conclusions findings summary materials dosing objective objectives references limitations "
    "methoden ergebnisse einleitung diskussion schlussfolgerung zusammenfassung résultats méthodes conclusion métodos resultados conclusiones introducción discusión "
    "результаты методы введение выводы обсуждение заключение परिणाम विधि निष्कर्ष النتائج الطرق المقدمة الخلاصة".split()
)


def _spans(t: str, a: int, b: int) -> tuple[list[tuple[int, int]], dict[int, int]]:
    """Outermost quotations and brackets of t[a:b] as (place of the opening, place of the close), and all by the place of the close.

    Unmatched signs are none.
    """
    if not _BRACKETS.search(t, a, b):
        return [], {}
    out: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []
    wanted: Counter[str] = Counter()
    for m in _BRACKETS.finditer(t, a, b):
        c, i = m.group(), m.start()
        if c == '"':
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), -1)
            before, after = (t[i - 1] if i > a else " "), (t[i + 1] if i + 1 < b else " ")
            opens = at < 0 and (before.isspace() or before in OPEN or before in ":：,，—" or _HAN.match(before) or not after.isspace())
            if at >= 0:
                for o, _ in stack[at:]:
                    wanted.subtract(_PAIR.get(o, ""))
                out.append((stack[at][1], i))
                del stack[at:]
            elif opens:
                stack.append((c, i))
            continue
        at = next((k for k in range(len(stack) - 1, -1, -1) if c in _PAIR.get(stack[k][0], "")), -1) if wanted[c] else -1
        if at >= 0:
            for o, _ in stack[at:]:
                wanted.subtract(_PAIR.get(o, ""))
            out.append((stack[at][1], i))
            del stack[at:]
        elif c in _PAIR:
            stack.append((c, i))
            wanted.update(_PAIR[c])
    out.sort()
    top: list[tuple[int, int]] = []
    for s in out:
        if not top or s[0] > top[-1][1]:
            top.append(s)
    return top, {e: o for o, e in out}


def _skip(t: str, i: int, b: int) -> int:
    while i < b and (t[i].isspace() or t[i] in "​﻿⁠"):
        i += 1
    return i


def _script(c: str) -> str:
    if _HAN.match(c):
        return "han"
    o = ord(c)
    if 0x900 <= o < 0x980:
        return "dev"
    if 0x600 <= o < 0x780 or 0x8A0 <= o < 0x900:
        return "arab"
    return "thai" if 0xE00 <= o < 0xE80 else "lao" if 0xE80 <= o < 0xF00 else "khmer" if 0x1780 <= o < 0x1800 else "burmese" if 0x1000 <= o < 0x10A0 else ""


def _continues(t: str, i: int) -> bool:
    """What stands at i, a letter of a script without case, opens a clause that runs on."""
    return t.startswith(RUNS_ON.get(_script(t[i]), ()), i)


def _begins(t: str, i: int, b: int) -> bool | None:
    """Whether a sentence may begin at i: yes, no, or by the look of it unknown (a small letter)."""
    if i >= b:
        return True
    c = t[i]
    if c in ",;:，；：、،—–)]}）】」』»”%=<>/" or unicodedata.category(c) == "Pd":
        return False
    if c in "¿¡":
        return True
    if c in OPEN or c in "\"'":
        return _begins(t, _skip(t, i + 1, b), b)
    if c.isupper() or c.isdigit():
        return True
    if not c.islower():
        return True
    word = _NAME.match(t, i, b).group()  # p53, mTOR, alpha-GENE2: a name keeps its small letter at the start
    return True if any(k.isdigit() or k.isupper() for k in word) else None


def _inside_bracket(t: str, a: int, s: int, e: int) -> bool:
    """The bracket t[s..e] is a text of its own: it opens with a beginning, ends with an end mark and stands between sentences."""
    i = _skip(t, s + 1, e)
    k = e - 1
    while k > s and (t[k].isspace() or t[k] in CLOSE or t[k] == '"'):
        k -= 1
    return k > i and t[k] in _END and (t[i].isupper() or t[i].isdigit() or bool(_script(t[i])) or t[i] in OPEN)


def _end_of(t: str, i: int, b: int, closes: dict[int, int]) -> int:
    """One past the closing quotes and brackets and the citation numbers set directly behind an end mark."""
    while i < b:
        if i in closes or (t[i] in CLOSE and t[i] not in "\u201c\u00bb\u203a"):
            i += 1
        elif t[i] in " \u00a0\u202f" and i + 1 in closes and t[i + 1] == "\u00bb":
            i += 2
        elif m := _CITED.match(t, i, b):
            i = m.end()
        else:
            return i
    return i


# Log odds for the end of a sentence, by kind of evidence.
NEVER, AGAINST, FOR = -20.0, -8.0, 8.0
FULL_STOP, POINT, LOUD, PAUSE, CLOSED = 4.0, 1.0, 4.0, -1.0, 3.0  # marks without other evidence
BEGINNING, SMALL_LETTER = 2.0, -3.0  # what follows looks like a beginning; a small letter follows
GLUED, GLUED_WORD = -6.0, 5.0  # nothing stands between; but a word ends before it and a capital follows
LIST_NUMBER, FRAGMENT, NO_PREDICATE = -12.0, -3.0, -8.0  # by where the sentence began
INITIAL, LABEL, OPENER = -5.0, 4.0, 3.0

_PARTS = frozenset("()[]{}«»“”„\"'‘’,;:/（）、，；：")


def _word_ending(t: str, a: int, e: int) -> str:
    """The word that ends at e, or its last letters if it is longer than all listed ones."""
    i, stop = e, max(a, e - _LONGEST_LISTED)
    while i > stop and t[i - 1] not in _PARTS and not t[i - 1].isspace():
        i -= 1
    return t[i:e]


def _own(t: str, i: int, opens: dict[int, int]) -> bool:
    """The bracket that opens at i is a text of its own."""
    return i in opens and _inside_bracket(t, i, i, opens[i])


def _opener(t: str, i: int, b: int) -> bool:
    word = _NAME.match(t, i, b)
    return bool(word) and word.group().rstrip(".!?…").lower() in OPENERS


def _point(t: str, a: int, s: int, e: int, after: int, nxt: int, b: int, begins: bool | None, opens: dict[int, int]) -> tuple[float, list[tuple[int, float]]]:
    """Evidence around a single point t[s:e]; what follows stands at nxt."""
    before = _word_ending(t, a, s)
    low = before.lower().strip("-–—")
    here, prev = t[nxt], (t[s - 1] if s > a else " ")
    terms: list[tuple[int, float]] = []
    if nxt == after == e:  # glued to what follows
        if here in "(«“„\"":
            return (GLUED + GLUED_WORD + BEGINNING if low not in ABBREVIATIONS and prev.isalnum() else AGAINST), terms
        if _script(here) == "han":
            return (GLUED + GLUED_WORD + BEGINNING if not prev.isdigit() and len(low) > 1 else AGAINST), terms
        if not (here.isupper() or here in "¿¡") or len(low) < 2 or "." in low or low in ABBREVIATIONS:
            return AGAINST, terms
        named = prev.isupper() and t[nxt + 1 : nxt + 2].islower() and any(k.isdigit() for k in before)
        return GLUED + POINT + (GLUED_WORD + BEGINNING if prev.islower() or prev.isdigit() or prev in ")]%" or named else 0.0), terms
    g = POINT + (BEGINNING if begins else SMALL_LETTER)
    if _script(prev) == "dev" and low:
        return g + (0.0 if low not in ABBREVIATIONS and "." not in low and len(low) > 2 and here.isascii() and here.isupper() else AGAINST), terms
    lead = t[max(a, s - len(before) - 8) : s - len(before)]
    pair = tail = None
    forms = {low}
    if "." in lead[-2:]:  # part of a longer abbreviation
        pair = re.search(r"(\w{1,2})\.\s?$", lead)
        tail = re.search(r"(?:\w\.\s?)+$", lead) if len(before) <= 2 else None
        forms |= {f"{pair.group(1).lower()}.{low}"} if pair else set()
        forms |= {re.sub(r"\s", "", tail.group()).lower() + low} if tail else set()
    bracket = here == "(" and not _own(t, nxt, opens)
    if len(low) > 6 and low.isalpha() and len(forms) == 1 and not bracket and low not in ABBREVIATIONS and low not in EITHER:
        return g + (OPENER if begins is None else 0.0), terms  # a full word: nothing below speaks of it
    if not forms.isdisjoint(EITHER):
        g += AGAINST if bracket or not begins or here.isdigit() and low not in ("etc", "др", "al") else 0.0
        name = _NAME.match(t, nxt, b)
        if "." in low and name and name.group().lower() in NAMED_BY_COUNTRY:
            g += AGAINST
        return g, terms
    if low == "mm" and before.isupper():
        return g + (0.0 if re.search(r"\d\s*$", lead) else AGAINST), terms  # a unit behind a number, else a title
    if low in NUMBERED and not pair:
        return g + (AGAINST if here.isdigit() or not begins else 0.0), terms
    if not forms.isdisjoint(ABBREVIATIONS):
        return g + AGAINST, terms
    if low.isdigit():
        if len(low) <= 2 and _word_ending(t, a, max(a, s - len(before) - 1)).lower() in ORDINAL_BEFORE:
            g += AGAINST
        terms.append((s - len(before), LIST_NUMBER))
        return g + (0.0 if begins else AGAINST), terms
    if len(before) == 1 and before.isalpha() and not _script(before):
        word = _word_ending(t, a, max(a, s - 2))
        if before.islower() or (len(word) > 2 and word.isupper() and word.isalpha()):  # in capitals, one letter is a word alike
            return g + (0.0 if begins and low in ONE_LETTER_WORDS and not pair and word else AGAINST), terms
        g += INITIAL + (LABEL if word.lower() in LABELLED else 0.0) + (OPENER if _opener(t, nxt, b) and not pair and not word.endswith(".") else 0.0)
        return g + (0.0 if begins else AGAINST), terms
    if _script(prev) == "arab" and len(low) == 1 or bracket:
        return g + AGAINST, terms
    if "." in low and all(len(p) <= 2 for p in low.split(".")) and not any(k.isdigit() for k in low):
        return g + (0.0 if begins else AGAINST), terms
    if begins is None and len(low) > 3:
        g += OPENER  # a capital may be lost behind a full word
    return g, terms


def _mark(t: str, a: int, m: re.Match, b: int, closes: dict[int, int], opens: dict[int, int]) -> tuple[float, list[tuple[int, float]]]:
    """Log odds that the marks m, outside quotations and brackets, end a sentence, and terms (place, odds) if it began there or later."""
    s, e, marks = m.start(), m.end(), m.group()
    after = _end_of(t, e, b, closes)
    nxt = _skip(t, after, b)
    if nxt >= b:
        return FOR, []
    begins = _begins(t, nxt, b)
    here, gap = t[nxt], nxt > after
    if begins is False:
        return NEVER, []
    if "…" in marks or marks.count(".") > 1:
        runs_on = _continues(t, nxt) or not gap if _script(here) else not (gap or here.isupper())
        return PAUSE + (BEGINNING if begins else NEVER) + (AGAINST if runs_on else 0.0), []
    if any(c in "。！？｡।॥؟۔។៕။" for c in marks):
        asked = marks[-1] in "！？؟" and _script(here) and _continues(t, nxt) and after > e
        return FULL_STOP + (AGAINST if asked else 0.0), []
    if "!" in marks or "?" in marks:
        return LOUD + (0.0 if begins else SMALL_LETTER + (0.0 if gap and after == e else AGAINST)), []
    return _point(t, a, s, e, after, nxt, b, begins, opens)


def _close(t: str, a: int, s: int, e: int, b: int, closes: dict[int, int]) -> tuple[int, float, list[tuple[int, float]]] | None:
    """Where a sentence ends if the quotation or bracket t[s..e] ends it, with log odds and terms; None if it cannot end one."""
    k = e - 1
    while k > s and (t[k].isspace() or t[k] in CLOSE or t[k] == '"'):
        k -= 1
    if t[k] not in _END:
        return None
    after = _end_of(t, e + 1, b, closes)
    nxt = _skip(t, after, b)
    if nxt >= b:
        return after, FOR, []
    if t[nxt] in _END:
        return None
    if t[s] not in _QUOTES:
        return (after, AGAINST, [(s, -AGAINST + CLOSED)]) if _inside_bracket(t, a, s, e) else None
    begins = _begins(t, nxt, b)
    if begins is False or begins is None and t[k] != "。":
        return None
    g, terms = CLOSED, [] if begins else [(s, AGAINST)]  # nothing but the quotation stands before a small letter
    if _script(t[nxt]):
        if _script(t[nxt]) != "thai":
            terms.append((s, NEVER))  # a quotation that opens the sentence is its subject or object
        g += AGAINST if _continues(t, nxt) else 0.0
    elif t[s] in "「『" and _continues(t, nxt):
        g += AGAINST
    return after, g, terms


class _Lexicon:
    """A dictionary of a script without blanks between words, and the classes of its words."""

    def __init__(self, script: str, more: frozenset[str] = frozenset()):
        final, opening, leads, others = LEXICON[script]
        self.final, self.opening, self.leads = frozenset(final), tuple(opening), frozenset(leads)
        self.words = frozenset((*final, *leads, *others, *(() if script == "thai" else opening))) | more  # Thai openings are several words
        self.longest = max(map(len, self.words))
        self.known: dict[str, tuple[str, ...]] = {}

    def cut(self, run: str) -> tuple[str, ...]:
        """A run of letters as words: the path through the lattice with the fewest unknown letters, then the fewest words."""
        if len(run) > 200:
            return self._cut(run)
        if run not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[run] = self._cut(run)
        return self.known[run]

    def _cut(self, x: str) -> tuple[str, ...]:
        n, words = len(x), self.words
        best: list[tuple[int, int]] = [(0, 0)] + [(1 << 60, 0)] * n
        for i in range(n):
            cost = best[i][0]
            if cost + 11 < best[i + 1][0]:
                best[i + 1] = (cost + 11, i)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                if x[i:j] in words and cost + 1 < best[j][0]:
                    best[j] = (cost + 1, i)
        out, j = [], n
        while j:
            i = best[j][1]
            out.append(x[i:j])
            j = i
        return tuple(reversed(out))


_THAI_RUN = _RUNS["thai"]
_LATIN_RUN = re.compile(r"[^\s฀-๿]+(?:[ \t ][^\s฀-๿]+)*[ \t \n\r]*")


def _predicate(words: tuple[str, ...]) -> bool:
    return any(w in THAI_PREDICATES and (not i or words[i - 1] not in THAI_MAKES_NOUN) for i, w in enumerate(words))


class _Gaps:
    """Evidence at the gaps of one block of a text."""

    def __init__(self, t: str, a: int, b: int, lexicons: dict[str, _Lexicon]):
        self.t, self.a, self.b, self.lexicons = t, a, b, lexicons
        self.runs = list(_THAI_RUN.finditer(t, a, b))
        self.ends = [r.end() for r in self.runs]
        self.words = [lexicons["thai"].cut(r.group()) for r in self.runs]
        said, self.said = -1, []
        for r, w in zip(self.runs, self.words, strict=True):  # where the last run with a predicate begins
            said = r.start() if _predicate(w) else said
            self.said.append(said)

    def thai(self, m: re.Match) -> tuple[float, list[tuple[int, float]]]:
        """A gap next to Thai letters."""
        t, (left, right) = self.t, (self.t[m.start() - 1], self.t[m.end()])
        i = bisect_left(self.ends, m.start())
        i = i if i < len(self.ends) and self.ends[i] == m.start() else i - 1  # the last run before the gap
        terms = [(self.said[i] + 1 if i >= 0 else self.a, NO_PREDICATE)]
        if _script(right) != "thai":
            return self._before_name(m, i), terms
        run, words = self.runs[i + 1].group(), self.words[i + 1]
        if _script(left) != "thai":
            if left in ",;:，；：" or left in OPEN or unicodedata.category(left) == "Pd":
                return NEVER, []
            number = left.isdigit() and _word_ending(t, self.a, m.start()).replace(".", "").isdigit()
            opens = run.startswith(THAI_AFTER_NUMBER if number else THAI_AFTER_NAME) or not number and run.startswith(THAI_AFTER_NAME_IF_SAID) and _predicate(words)
            waits = i < 0 or self.words[i][-1] in ("ว่า", "ที่", "ซึ่ง")
            return (CLOSED if opens else -CLOSED) + (AGAINST if waits else 0.0), terms
        return self._between(self.lexicons["thai"], self.words[i], run, words, _predicate(words)), terms

    def _between(self, lexicon: _Lexicon, before: tuple[str, ...], run: str, words: tuple[str, ...], says: bool) -> float:
        """A gap between letters of one script."""
        opening = run.startswith(lexicon.opening)
        final = before[-1] in lexicon.final
        runs_on = not opening and words[0] in lexicon.leads or before[-1] in lexicon.leads and not final
        return -1.0 + 3.0 * opening + 4.0 * final + 2.0 * says + (AGAINST if runs_on else 0.0)

    def _before_name(self, m: re.Match, i: int) -> float:
        """A gap between Thai and a Latin name, number or sign."""
        t, b = self.t, self.b
        if _begins(t, m.end(), b) is False:
            return NEVER
        if self.runs[i].group().endswith(THAI_POLITE):
            return FOR - NO_PREDICATE
        if not t[m.end()].isalpha():
            return AGAINST  # a number counts, a bracket or quotation belongs to what stands before it
        words = self.words[i]
        before, last = words[-2] if len(words) > 1 else "", words[-1]
        name = _LATIN_RUN.match(t, m.end(), b)
        takes = last not in self.lexicons["thai"].words or last in THAI_TAKES and before not in THAI_NUMERALS
        if takes or len(name.group().strip()) < 2 or i + 1 >= len(self.runs) or self.runs[i + 1].start() != name.end():
            return AGAINST
        return CLOSED if _predicate(self.words[i + 1][:1]) else AGAINST

    def other(self, m: re.Match) -> float:
        """A gap between letters of another script without blanks; lines are wrapped anywhere in these scripts."""
        t, left, right = self.t, _script(self.t[m.start() - 1]), _script(self.t[m.end()])
        if left != right or left not in self.lexicons:
            return NEVER
        lexicon, i = self.lexicons[left], m.start()
        while i > self.a and _RUNS[left].match(t[i - 1]):
            i -= 1
        run = _RUNS[left].match(t, m.end(), self.b)
        if not run or i == m.start():
            return NEVER
        before, words = lexicon.cut(t[i : m.start()]), lexicon.cut(run.group())
        opening, final = words[0] in lexicon.opening, before[-1] in lexicon.final
        return -3.0 + 2.0 * opening + (2.0 if len(before[-1]) < 2 else 3.0) * final + (AGAINST if before[-1] in lexicon.leads or words[0] in lexicon.leads else 0.0)


class _Best:
    """Best scores of growing ranges: a list whose maximum over any range is found by parts of 64."""

    def __init__(self):
        self.all: list[float] = []
        self.parts: list[float] = []

    def add(self, x: float) -> None:
        self.all.append(x)
        if len(self.all) % 64 == 0:
            self.parts.append(max(self.all[-64:]))

    def last_best(self, lo: int, hi: int) -> tuple[float, int]:
        """(score, place) of the best in lo..hi-1."""
        p, q = -(-lo // 64), hi // 64
        if p < q:
            at = p + max(range(q - p), key=self.parts[p:q].__getitem__)
            whole = self.all.index(self.parts[at], at * 64, at * 64 + 64)
            ends = [x for x in (self._flat(lo, p * 64), self._flat(q * 64, hi)) if x]
            return max([(self.all[whole], whole), *ends])
        return self._flat(lo, hi)

    def _flat(self, lo: int, hi: int) -> tuple[float, int] | None:
        if lo >= hi:
            return None
        x = max(self.all[lo:hi])
        return x, self.all.index(x, lo, hi)


def best_path(nodes: list[tuple[int, int, int, float, list]], start: int) -> list[tuple[int, int]]:
    """(start, end) of the sentences of the best path through a lattice of terminators.

    A node is (place, end, next, odds, terms): read as an end at ``place``, the sentence goes to ``end`` and the next one begins at
    ``next``; it counts its odds and those of the terms (place, odds) whose place is not behind the sentence's start. Read as inside,
    it counts nothing. The last node ends the block. Nodes are ordered by place and their ``next`` never goes back.
    """
    starts, before = [start], [-1]
    scores = _Best()
    scores.add(0.0)
    so_far = [(0.0, 0)]  # the best of all sentence starts up to each
    for place, _, nxt, odds, terms in nodes:
        reach = len(starts) if starts[-1] <= place else bisect_left(starts, place + 1)  # sentences that begin at this place or before
        last = starts[reach - 1]
        cuts = {bisect_left(starts, p) for p, _ in terms if p <= last}
        if not cuts:
            x, i = so_far[reach - 1]
            found = (x + odds, i)
        else:
            edges = sorted({0, reach, *cuts})
            found = (-1e18, 0)
            for lo, hi in zip(edges, edges[1:]):
                x, i = scores.last_best(lo, hi)
                found = max(found, (x + odds + sum(d for p, d in terms if starts[lo] >= p), i))
        starts.append(max(nxt, starts[-1]))
        scores.add(found[0])
        so_far.append((found[0], len(starts) - 1) if found[0] > so_far[-1][0] else so_far[-1])  # of equals the earliest
        before.append(found[1])
    out, j = [], len(nodes)
    while j > 0:
        i = before[j]
        out.append((starts[i], nodes[j - 1][1]))
        j = i
    return out[::-1]


_INVISIBLE = "​﻿⁠"


def _back(t: str, a: int, i: int) -> int:
    """One past the last visible character of t[a:i]."""
    while i > a and (t[i - 1].isspace() or t[i - 1] in _INVISIBLE):
        i -= 1
    return i


def _item_after(t: str, a: int, end: int, sign: str, previous: bool) -> bool:
    """A list sign at the start of a line opens an item behind the text t[a:end]."""
    if end == a or previous or t[end - 1] in _END and t[end - 1] != ".":
        return True
    if t[end - 1] == ".":
        low = _word_ending(t, a, end - 1).lower()
        return low not in ABBREVIATIONS and len(low) > 1
    return t[end - 1] in "]" or t[end - 1] in ":：" and sign[0] != "("


def _forced(t: str, a: int, b: int) -> tuple[list[int], dict[int, int]]:
    """Places where headings end and list items begin, and where the text of each item begins behind its sign."""
    cuts: set[int] = set()
    behind_sign: dict[int, int] = {}
    line, previous = a, False
    while line < b:
        stop = t.find("\n", line, b)
        stop = b if stop < 0 else stop
        at = _skip(t, line, stop)
        m = _ITEM.match(t, at, b)
        prior = _back(t, a, line)
        if m and at < stop and _item_after(t, a, prior, m.group(), previous):
            if prior > a:
                cuts.add(at)
            behind_sign[at] = m.end()
            previous = True
        else:
            if stop < b and prior == a and (words := t[line:stop].split()):
                title = words[0].lower() in TITLES and (len(words) == 1 or words[-1].lower() in TITLES)
                if title and words[-1][-1].isalpha() and t[stop + 1 : stop + 2].isupper():
                    cuts.add(_skip(t, stop, b))
            previous = False
        line = stop + 1
    return sorted(cuts), behind_sign


def _block(t: str, a: int, b: int, lexicons: dict[str, _Lexicon], out: list[tuple[int, int]]) -> None:
    """Sentences of t[a:b], a text between blank lines."""
    start = _skip(t, a, b)
    if start >= b:
        return
    cuts, behind_sign = _forced(t, a, b)
    top, closes = _spans(t, a, b)
    opens = {o: e for e, o in closes.items()}
    nodes: list[tuple[int, int, int, int, float, list]] = []
    tops = [s for s, _ in top]
    signs = sorted(behind_sign)

    def add(place: int, end: int, odds: float, terms: list, kind: int) -> None:
        i = bisect_left(signs, place + 1) - 1 if signs else -1
        if odds > NEVER / 2 and not (i >= 0 and place < behind_sign[signs[i]]):  # what stands in a list sign ends nothing
            nodes.append((place, kind, end, _skip(t, end, b), odds, terms))

    def inside(place: int) -> bool:
        i = bisect_left(tops, place) - 1 if tops else -1
        return i >= 0 and place < top[i][1]

    letter, seen = a, a
    for m in _MARKS.finditer(t, a, b):
        if not inside(m.start()):
            k = m.start()
            while k > seen and not t[k - 1].isalnum():
                k -= 1
            letter = k if k > seen else letter
            seen = m.end()
            odds, terms = _mark(t, a, m, b, closes, opens)
            add(m.start(), _end_of(t, m.end(), b, closes), odds, [*terms, (letter, FRAGMENT)], 1)
    for s, e in top:
        if node := _close(t, a, s, e, b, closes):
            add(e, *node, 2)
    if _THAI_RUN.search(t, a, b):
        gaps = _Gaps(t, a, b, lexicons)
        for m in _THAI_GAP.finditer(t, a, b):
            if not inside(m.start()):
                odds, terms = gaps.thai(m)
                add(m.start(), m.start(), odds, terms, 3)
    if _GAP.search(t, a, b):
        gaps = _Gaps(t, a, b, lexicons)
        for m in _GAP.finditer(t, a, b):
            if not inside(m.start()):
                add(m.start(), m.start(), gaps.other(m), [], 3)
    nodes += [(c, 0, c, c, 1e6, []) for c in cuts]
    nodes += [(b, 4, b, b, 0.0, [])]
    nodes.sort(key=lambda x: x[:2])
    for i, k in best_path([(p, e, n, g, x) for p, _, e, n, g, x in nodes], start):
        if (k := _back(t, i, k)) > i:
            out.append((i, k))


_built: dict[str, _Lexicon] = {k: _Lexicon(k) for k in LEXICON}


def _with_words(words: Iterable[str]) -> dict[str, _Lexicon]:
    more = frozenset(words)
    return _built if not more else {k: _Lexicon(k, frozenset(w for w in more if w and _script(w[0]) == k)) for k in LEXICON}


def thai_words(x: str) -> list[str]:
    """A run of Thai letters as words."""
    return list(_built["thai"].cut(x))


def split(text: str, lexicons: dict[str, _Lexicon] = _built) -> list[tuple[int, int]]:
    """(start, end) of every sentence in code points. Together they cover all that is visible; blank texts have none."""
    out: list[tuple[int, int]] = []
    at = 0
    for m in _BLOCK.finditer(text):
        _block(text, at, m.start(), lexicons, out)
        at = m.end()
    _block(text, at, len(text), lexicons, out)
    return out


def _run(words: tuple[str, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicons = _with_words(words)
        for b in batches:
            rows = [(d, s, e) for d, t in zip(b["doc"], b["text"], strict=True) for s, e in split(t, lexicons)]
            yield pd.DataFrame(rows, columns=["doc", "start_pos", "end_pos"])

    return run


def sentences(docs: DataFrame, doc: str, text: str, words: Iterable[str] = ()) -> DataFrame:
    """(doc, start_pos, end_pos): one row per sentence, over whole texts; ``words`` are added to the dictionaries of their scripts.

    Null, empty and blank texts give no rows; repeated documents give repeated rows. One pass without a shuffle.
    """
    ship(docs.sparkSession)
    x = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text")).where("text is not null and text <> ''")
    kind = docs.schema[doc].dataType.simpleString()
    return x.mapInPandas(_run(tuple(words)), f"doc {kind}, start_pos int, end_pos int").withColumnRenamed("doc", doc)
