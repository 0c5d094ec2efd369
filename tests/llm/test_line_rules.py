import random
import re
from collections import Counter

from ledgermill.llm.line_rules import BOILERPLATE, line_quality
from tests.llm import helpers


def base_counts(text):
    text = text or ""
    own = helpers.words(text)
    windows = Counter(tuple(own[i : i + 8]) for i in range(len(own) - 7))
    repeated = set()
    for i in range(len(own) - 7):
        if windows[tuple(own[i : i + 8])] > 1:
            repeated.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if helpers.WORD.search(line)]
    failed = len(own) < 20 or 100 * len(repeated) > 30 * len(own)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_edge_cases_against_brute_force(spark):
    texts = [*helpers.edge_texts(), (95, "same line\n" * 5 + helpers.edge_texts()[15][1])]
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = helpers.as_counter(line_quality(helpers.documents(spark, texts)), *columns)
    assert got == Counter((i, *base_counts(t)) for i, t in texts)


def line_fails(line, n_words):
    own = helpers.words(line)
    if not own:
        return False
    bars = sum(word in ("|", ">", "»") for word in own)
    capitals, smalls = (len(re.findall(kind, line)) for kind in ("[A-Z]", "[a-z]"))
    return (
        10 * len(re.findall(r"[#*$%&|<>]", line)) > sum(map(len, own))
        or (bars >= 2 and len(own) - bars <= 4 * (bars + 1))
        or (len(own) <= 2 and own[-1][-1] not in ".!?\"':;,)]" and n_words > 8)
        or (len(own) >= 3 and capitals > 2 * smalls)
        or (len(own) >= 3 and 2 * sum(a == b for a, b in zip(own, own[1:], strict=False)) > len(own))
        or (len(own) <= 20 and any(phrase.decode() in line.translate(helpers.LOWER) for phrase in BOILERPLATE))
    )


def plain_verdict(text):
    n_words, *_, base_failed = base_counts(text)
    lines = (text or "").split("\n")
    failed = [line_fails(line, n_words) for line in lines]
    lost = sum(len(helpers.words(line)) for line, bad in zip(lines, failed, strict=True) if bad)
    clean = "\n".join(line for line, bad in zip(lines, failed, strict=True) if not bad)
    if any(failed) and (text or "").endswith("\n"):
        clean = clean.removesuffix("\n")
    return not base_failed and lost <= 0.4 * n_words, clean


def rule_texts():
    rnd = random.Random(2)
    long = helpers.prose(rnd, 60).replace("\n", " ")
    furniture = [
        "Home » About » Contact » News",
        "Home | About us | Contact",
        "a|b|c",
        "Menu",
        "Yes.",
        "go go go go",
        "THIS IS LOUD",
        "### $$$ ***",
        "Read our Privacy Policy here",
        "",
        " \t",
        "ñandú » x",
    ]
    texts = [f"{long} if a > b and c > d", f"our privacy policy says {long}", f"{long}\n{furniture[0]}"]
    for _ in range(60):
        lines = [rnd.choice([long[:90], long, *furniture]) for _ in range(rnd.randrange(1, 9))]
        texts.append("\n".join(lines) + rnd.choice(["", "\n"]))
    return texts


def test_verdicts_and_kept_lines_against_a_plain_version(spark):
    texts = [*helpers.edge_texts(), *enumerate(rule_texts(), 1000)]
    got = helpers.as_counter(line_quality(helpers.documents(spark, texts), with_text=True), "doc_id", "kept", "clean_text")
    assert got == Counter((i, *plain_verdict(t)) for i, t in texts)


def test_clean_lines_with_comparisons_and_phrases_stay(spark):
    compared, phrase, menu = rule_texts()[:3]
    rows = line_quality(helpers.documents(spark, [(1, compared), (2, phrase), (3, menu)]), with_text=True).collect()
    got = {r["doc_id"]: (r["kept"], r["clean_text"]) for r in rows}
    assert got == {1: (True, compared), 2: (True, phrase), 3: (True, menu.split("\n")[0])}


def test_failing_lines_are_removed_and_lossy_documents_rejected(spark):
    prose = "The quick brown fox went over the hill to see what was there today.\nThen it came back home, tired and happy."
    texts = {
        1: prose,
        2: f"{prose}\nHome | About us | Contact\nCopyright, all rights reserved.\n### $$$ *** %%%",
        3: "AAA BBB CCC DDD EEE FFF GGG HHH III JJJ KKK LLL MMM NNN OOO\n" + prose[:70] + "\nXXX YYY ZZZ WWW VVV UUU",
        4: "\n".join([prose, "Menu", "go go go go go go go go"]),
    }
    rows = line_quality(helpers.documents(spark, list(texts.items())), with_text=True).collect()
    got = {r["doc_id"]: (r["kept"], r["clean_text"]) for r in rows}
    assert got[1] == (True, prose)
    assert got[2] == (True, prose)
    assert not got[3][0]
    assert "Menu" not in got[4][1].split() or got[4][0]
    assert "go go" not in got[4][1]


def test_empty_table(spark):
    assert line_quality(helpers.documents(spark, [(1, "a")]).limit(0)).collect() == []
