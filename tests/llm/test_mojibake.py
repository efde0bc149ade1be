import re

import pytest

from folioforge.llm.mojibake import SUSPECT, garbled, repair

KO, JA, EN, FR, DE = "하늘의 등불은 왜 오래된 성문 앞에서 사라졌을까요?", "夜明けに、静かな森で古い地図を見つけました。", "“Liraja’s chapel defends it” – and waits…", "L’été dernier, la forêt protège la clé dorée.", "Früher stärkte die Königin die Brücke mit größter Mühe."


def sloppy(data: bytes) -> str:
    return "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in data)


ROUND = [
    (KO, lambda t: sloppy(t.encode())),
    (JA, lambda t: sloppy(t.encode())),
    (EN, lambda t: sloppy(t.encode())),
    (FR, lambda t: t.encode().decode("latin-1")),
    (DE, lambda t: sloppy(sloppy(t.encode()).encode())),
    (KO, lambda t: sloppy(sloppy(t.encode()).encode())),
    (KO, lambda t: t.encode().decode("mac_roman")),
    (EN, lambda t: t.encode().decode("cp437")),
    (EN, lambda t: "".join(bytes([b]).decode("cp1251", "ignore") or chr(b) for b in t.encode())),
    (FR, lambda t: t.encode().decode("cp1251")),
    (KO, lambda t: sloppy(t.encode("cp949"))),
    ("★★★☆ ┌──┐", lambda t: sloppy(t.encode("cp949"))),
    (JA, lambda t: sloppy(t.encode("cp932"))),
    (JA, lambda t: t.encode("euc_jp").decode("latin-1")),
]
CLEAN = ["", "plain", KO, JA, EN, FR, DE, "@señor91 «¡!»", "— Вера_90 😀", "├─ 1 ─┤ ╔══╗", "縺れた糸", "ﾅﾆ!? €€€ ★★★☆ (╯°□°)╯", "Âme Ç57elik ÃO66 Øresund", "1×2÷3 °C ± ½ √ OK", "ｌｅｇｉｏｎ", "Ångström ÄÖÜß22 naïve", "@濡沫11 왕실의 허락을", "Гёте живёт «в Риге» – № 5", "É»"]

RU, PL = "Привет, мир, это обычный текст о погоде", "Zażółć gęślą jaźń, proszę wybrać łódź"
ZH, TW = "今天我们来说说这个游戏的故事，大家都很喜欢", "今天我們來說說這個遊戲的故事，大家都很喜歡"
FAR = ["مرحبا بالعالم هذا نص", "שלום עולם זה טקסט", "สวัสดีชาวโลก", "नमस्ते दुनिया", "Καλημέρα κόσμε", "გამარჯობა მსოფლიო", RU]
ROUND += [(t, lambda t: t.encode().decode("latin-1")) for t in FAR]
ROUND += [
    (PL, lambda t: sloppy(t.encode())),
    (PL, lambda t: "".join(bytes([b]).decode("cp1250", "ignore") or chr(b) for b in t.encode())),
    (RU, lambda t: t.encode("cp1251").decode("latin-1")),
    (RU, lambda t: t.encode("koi8_r").decode("latin-1")),
    (ZH, lambda t: t.encode("gbk").decode("latin-1")),
    (TW, lambda t: t.encode("big5").decode("latin-1")),
]
CLEAN += [*FAR, PL, ZH, TW]


def test_any_number_of_layers():
    text = broken = "Café é über – naïve “quoted” tradition"
    for _ in range(8):
        broken = broken.encode().decode("latin-1")
        assert repair(broken)[0] == text


@pytest.mark.parametrize("n", range(len(ROUND)))
def test_exact_round_trip(n):
    text, spoil = ROUND[n]
    for original in (text, f"# Title\n\n{text}\nclean line"):
        broken = "\n".join(spoil(line) if line == text else line for line in original.split("\n"))
        assert broken != original
        fixed, undone, whole = repair(broken)
        assert fixed == original and undone and whole, (broken, fixed)


@pytest.mark.parametrize("text", CLEAN)
def test_clean_text_stays(text):
    assert repair(text) == (text, [], True)


def test_a_garbled_stretch_among_clean_text():
    broken = f"{KO} {sloppy(KO.encode('cp949'))} {KO}"
    assert repair(broken)[0] == f"{KO} {KO} {KO}"


def test_lost_characters():
    fixed, undone, whole = repair("f�r das Reich")
    assert undone == ["lost characters"] and not whole and fixed == "f�r das Reich"
    assert repair("it\x81fs")[1:] == (["lost characters"], False)
    assert repair(JA.encode().decode("cp932", "replace"))[1]


def test_table(spark):
    rows = [(n, t, "x") for n, t in enumerate([spoil(t) for t, spoil in ROUND])] + [(100 + n, t, "x") for n, t in enumerate(CLEAN)] + [(200, None, "x"), (None, ROUND[0][1](KO), "x"), (201, "a" * 300_000 + "Ã©", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, restored string")
    out = garbled(df, "doc_id", "text").collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in out) == [-1, *range(len(ROUND)), 201]
    assert all(r.restored == ROUND[r.doc_id][0] for r in out if r.doc_id is not None and r.doc_id < 100)
    assert garbled(df.limit(0), "doc_id", "text").count() == 0
    assert re.compile(re.sub(r"\\x\{(\w+)\}", lambda m: "\\u" + m[1].zfill(4), SUSPECT))
