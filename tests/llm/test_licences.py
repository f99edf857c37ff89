from helpers import ODD, docs_of

from starledger.llm.licences import LEAST, TEMPLATES, anchors, scan

MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."


def files_of(spark, rows):
    return spark.createDataFrame(rows, "path string, text string, term string, license string").select("path", "text", "term", "license")


def got(df):
    return {r["path"]: (r["own_license"], r["license"], r["licensed_by"], r["levels_up"]) for r in df.collect()}


def test_inherits_from_the_nearest_licensed_directory(spark):
    rows = [("a/LICENSE", MIT), ("a/b/c/code.py", "some words here"), ("a/b/COPYING.txt", "intro\n" + APACHE),
            ("a/b/c/own.py", "x\n  released UNDER the mit license \ny"), ("a/z.py", None), ("top.py", "plain"),
            ("ab/z.py", "a directory whose name begins alike")]
    r = got(scan(files_of(spark, [(p, t, "x", "y") for p, t in rows])))
    assert r["a/LICENSE"] == ("MIT", "MIT", None, None)
    assert r["a/b/c/code.py"] == (None, "Apache-2.0", "a/b", 1)
    assert r["a/b/c/own.py"][:2] == ("MIT", "MIT")
    assert r["a/z.py"] == (None, "MIT", "a", 0)
    assert r["top.py"] == r["ab/z.py"] == (None, None, None, None)


def test_root_licence_reaches_all_and_repeated_rows_are_one_file(spark):
    rows = [("LICENSE", MIT), ("LICENSE", MIT), ("x/y.py", "words"), (None, "no path")]
    r = got(scan(files_of(spark, [(p, t, "x", "y") for p, t in rows])))
    assert r["x/y.py"] == (None, "MIT", "", 1) and len(r) == 3
    assert r[""][1] == "MIT"


def test_below_the_threshold_is_no_licence(spark):
    rows = [("a.py", "the license of this work is under general discussion in public, version to follow later on"),
            ("b.py", "License"), ("c.py", "This work is licensed under the GNU General Public License, version 3.")]
    r = got(scan(files_of(spark, [(p, t, "x", "y") for p, t in rows])))
    assert r["a.py"][0] is None and r["b.py"][0] is None and r["c.py"][0] == "GPL-3.0"


def test_every_template_names_itself(spark):
    rows = [(f"f{i}.txt", "some text before\n" + t) for i, (_, t) in enumerate(TEMPLATES)]
    r = got(scan(files_of(spark, [(p, t, "x", "y") for p, t in rows])))
    assert [r[f"f{i}.txt"][0] for i in range(len(TEMPLATES))] == [n for n, _ in TEMPLATES]


def test_anchors_cover_all_that_can_reach_the_threshold():
    v = {"a": 10, "b": 9, "c": 8, "d": 1}
    rest = sum(w * w for t, w in v.items() if t not in anchors(v))
    assert rest < LEAST**2 * sum(w * w for w in v.values())


def test_odd_and_empty_tables(spark):
    docs = docs_of(spark, ODD, extra=False).selectExpr("cast(doc_id as string) path", "text", "source as term")
    assert scan(docs).count() == len({r[0] for r in ODD})
    assert scan(docs.limit(0)).count() == 0


def wrapped(text, width, mark):
    out, line = [], mark
    for word in text.split():
        if len(line) + 1 + len(word) > width:
            out.append(line)
            line = mark
        line += " " + word
    return "\n".join([*out, line])


def test_wrapped_headers_and_whole_texts_are_found(spark):
    """Every template, wrapped at two widths behind comment marks, after a
    copyright line and before code without a blank line."""
    rows, want = [], {}
    for i, (name, text) in enumerate(TEMPLATES):
        for width, mark in ((60, "#"), (78, " *")):
            path = f"src{i}/w{width}.c"
            rows.append((path, f"{mark} Copyright 2021 The Example Authors\n{mark}\n{wrapped(text, width, mark)}\n"
                               "int main(void) {\n  return sum_of_all(first, second);\n}\n"))
            want[path] = name
    r = got(scan(files_of(spark, [(p, t, "x", "y") for p, t in rows])))
    # the redistribution clause of the BSD texts begins both of them
    assert {p: r[p][0] for p in want} == want


def test_licence_files_license_their_directories(spark):
    whole = {n: t for n, t in TEMPLATES}
    mit = "The MIT License\n\nCopyright (c) 2020 Someone Else\n\n" + wrapped(whole["MIT"], 79, "")
    gpl = next(t for n, t in TEMPLATES if n == "GPL-3.0" and "verbatim" in t)
    body = "\n".join(f"  {i}. Clause {i} says that party number {i} owes duty number {i} to the others." for i in range(400))
    rows = [("m/LICENSE", mit), ("m/x/code.py", "print(1)"), ("g/COPYING", wrapped(gpl, 60, "") + "\n\n" + body),
            ("g/code.py", "print(2)")]
    r = got(scan(files_of(spark, [(p, t, "x", "y") for p, t in rows])))
    assert r["m/LICENSE"][0] == "MIT" and r["m/x/code.py"] == (None, "MIT", "m", 1)
    assert r["g/COPYING"][0] == "GPL-3.0" and r["g/code.py"] == (None, "GPL-3.0", "g", 0)


def test_talk_about_licences_is_no_notice(spark):
    talk = ["We compared the MIT License with the Apache License\nand found that the conditions of both are easily met by most\n"
            "companies that distribute source code to their customers.",
            "Redistribution of wealth and use of land in source regions\nwith or without modification of tax law is a matter of\n"
            "debate, provided that conditions allow it.",
            "The General Public is invited to redistribute leaflets and\nmodify the terms under which the Foundation has published\n"
            "either version of its yearly report."]
    r = got(scan(files_of(spark, [(f"t{i}.txt", t, "x", "y") for i, t in enumerate(talk)])))
    assert all(v[0] is None for v in r.values())


def test_a_notice_of_many_lines_and_a_line_said_many_times(spark):
    """Long texts: a header far inside, and one notice on each of many lines."""
    text = next(t for n, t in TEMPLATES if n == "Apache-2.0" and "WARRANTIES" in t)
    rows = [("far.c", "\n".join(f"int v{i} = {i};" for i in range(5000)) + "\n" + wrapped(text, 70, "//") + "\nint end;"),
            ("many.txt", "\n".join(["Released under the MIT License."] * 2000))]
    r = got(scan(files_of(spark, [(p, t, "x", "y") for p, t in rows])))
    assert r["far.c"][0] == "Apache-2.0" and r["many.txt"][0] == "MIT"


def test_windows_match_a_plain_scan_of_all_windows(spark):
    import math
    import random
    from collections import Counter
    import re

    from starledger.llm.licences import LICENCE_NAME, TERM, weight

    draw = random.Random(5)
    files = {}
    for i in range(30):
        words = draw.choice(TEMPLATES)[1].split()
        cut = [w for w in words if draw.random() > draw.choice([0, 0.1, 0.3])]
        noise = [draw.choice(["alpha", "the", "license", "of", "42"]) for _ in range(draw.randrange(12))]
        files[f"{draw.choice(['a', 'b', 'c/d'])}/{draw.choice(['LICENSE', 'x'])}{i}"] = (
            wrapped(" ".join(noise), 30, "--") + "\n\n" + wrapped(" ".join(cut), draw.choice([30, 50, 70]), "--") + "\nend of it")
    terms = {p: [re.findall(TERM, l.lower()) for l in t.split("\n")] for p, t in files.items()}
    holding = Counter(t for ls in terms.values() for t in {x for l in ls for x in l})
    value = lambda c: {t: tf * weight(len(files), holding[t] if t in vocabulary else 0) for t, tf in c.items()}
    counted = [(n, Counter(re.findall(TERM, t.lower()))) for n, t in TEMPLATES]
    vocabulary = {t for _, c in counted for t in c}
    want = {}
    for p, ls in terms.items():
        best = []

        def score(unit, of):
            u = value(Counter(unit))
            for i, (name, c) in enumerate(counted):
                if of in (-1, i) and (dot := sum(w * u.get(t, 0) for t, w in value(c).items())):
                    norms = math.sqrt(sum(w * w for w in u.values())) * math.sqrt(sum(w * w for w in value(c).values()))
                    best.append((-dot / norms, name))

        for l in ls:
            score(l, -1)
        if re.search(LICENCE_NAME, p):
            score([t for l in ls for t in l], -1)
        full = [l for l in ls if l]
        for i, (_, c) in enumerate(counted):
            n = sum(c.values())
            for s in range(len(full)):
                if not c.keys() & set(full[s]):
                    continue
                e = s
                while e < len(full) and sum(map(len, full[s:e])) < n:
                    e += 1
                score([t for l in full[s:e] for t in l], i)
                if e - 1 > s and sum(map(len, full[s:e])) > n:
                    score([t for l in full[s:e - 1] for t in l], i)
        top = min(best, default=(0, None))
        want[p] = (round(-top[0], 9), top[1]) if -top[0] >= LEAST else None
    rows = scan(files_of(spark, [(p, t, "x", "y") for p, t in files.items()])).collect()
    assert {r["path"]: r["own_license"] and (round(r["own_score"], 9), r["own_license"]) for r in rows} == want
    assert sum(v is not None for v in want.values()) > 10
