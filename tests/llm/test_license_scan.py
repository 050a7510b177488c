import hashlib
import os
import textwrap

import pytest

from tierline.llm.license_scan import KNOWN, TITLES, canonical, read_licenses, scan

SCHEMA = "doc_id long, text string"
MIT = KNOWN[3][1]


def _scan(spark, rows, schema=SCHEMA):
    return sorted(tuple(r) for r in scan(spark.createDataFrame(rows, schema)).collect())


def test_units_and_spellings(spark):
    wrapped = "Copyright (c) 2020 Some One\n© 2021 Others. All rights reserved.\n\n" + MIT.replace(" OR ", " or\n").replace(", ", " ,  ")
    rows = [
        (1, "released UNDER the   mit licence!"),
        (2, "Some words.\nLicensed under the Apache Licence, version 2.0\nMore; Released under the MIT License. No."),
        (3, wrapped),
        (4, "Intro of it.\n\n" + wrapped + "\n\nThe end."),
        (5, "This is not Released under the MIT License."),
        (6, "License"),
    ]
    assert _scan(spark, rows) == [(1, "MIT", "text", 1), (2, "Apache-2.0", "line", 1), (3, "MIT", "paragraph", 1), (3, "MIT", "text", 1), (4, "MIT", "paragraph", 1)]


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    line = "Licensed under CC BY-NC 4.0."
    rows = [(None, line, 1, "x"), (1, None, 1, "x"), (1, "", 1, "x"), (2, f"{line}\nb", 1, "x"), (2, f"{line}\nb", 1, "x"), (3, "word \n" * 200_000 + line + "\n" + line, 1, "x")]
    got = scan(spark.createDataFrame(rows, SCHEMA + ", license int, digest string")).collect()
    assert sorted((r["doc_id"] or 0, r["unit"], r["n"]) for r in got) == [(0, "text", 1), (2, "line", 2), (3, "line", 2)]
    assert {r["license"] for r in got} == {"CC-BY-NC-4.0"}
    assert scan(spark.createDataFrame([], SCHEMA)).count() == 0


TEXTS = {name: text for name, text in KNOWN if "\n" in text}


def _wrapped(text, width=60):
    return "\n\n".join(textwrap.fill(p, width) for p in text.split("\n"))


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_usual_files_are_found(spark, name):
    """A title, copyright lines, wrapped paragraphs; within a longer text; on one page."""
    body = _wrapped(TEXTS[name])
    titles = [title for of, title in TITLES if of == name]
    rows = [
        (1, f"{titles[0] if titles else name}\n\nCopyright (c) 2020 Some One\nCopyright (c) 2021 Another\n\n{body}\n"),
        (2, f"# A project\n\nWhat it does.\n\n## Licence\n\n{body}\n\nThanks to all."),
        (3, f"{body} More words of the last paragraph."),
        (4, "\n".join([titles[0], "Copyright 2020 by Some One", TEXTS[name]]) if titles else TEXTS[name]),
        (5, f"{body}\n\n{body}"),
    ]
    found = [r for r in _scan(spark, rows) if r[1] == name]
    assert [r for r in found if r[2] in ("text", "paragraphs")] == (
        [(1, name, "paragraphs", 1)] + ([(1, name, "text", 1)] if titles else []) + [(2, name, "paragraphs", 1), (4, name, "text", 1), (5, name, "paragraphs", 2)]
    )


def test_adjoining_equivalents_are_all_spelled(spark):
    rows = [(1, "licence licence licence"), (2, "sub licence, sub-license; Licence http"), (3, "license licence of")]
    known = [("three", "license license license"), ("pairs", "sublicense sublicense license https")]
    got = scan(spark.createDataFrame(rows, SCHEMA), known).collect()
    assert sorted((r["doc_id"], r["license"]) for r in got) == [(1, "three"), (2, "pairs")]


def test_a_folder_of_licenses(spark, tmp_path):
    (tmp_path / "Own-1.0.txt").write_text("You may do\nanything with this text.\n\nBut not sell it.")
    (tmp_path / "Other.md").write_text("Do nothing at all.")
    known = read_licenses(spark, str(tmp_path))
    assert sorted(k for k, _ in known) == ["Other", "Own-1.0"]
    rows = [(1, "Title\n\nYOU MAY do anything, with this text.\n\nBut not sell it!\n\nEnd"), (2, "do nothing at all"), (3, "x")]
    got = scan(spark.createDataFrame(rows, SCHEMA), known).collect()
    assert sorted((r["doc_id"], r["license"], r["unit"]) for r in got) == [(1, "Own-1.0", "paragraphs"), (2, "Other", "text")]
    assert scan(spark.createDataFrame(rows, SCHEMA), [], digests=[]).count() == 0


def test_long_licenses_are_found_by_their_digest(spark, tmp_path):
    """One of more words than anybody types, known by head, length and digest only."""
    parts = ["My Public Licence, Version 1", *(f"{n}. You may do this and that, {n} times over." for n in range(300))]
    body = "\n\n".join(parts)
    text = canonical(spark.createDataFrame([(body,)], "t string"), "t").first()["t"]
    known = [("MyPL-1", " ".join(text.split()[:4]), len(text), hashlib.sha256(text.encode()).hexdigest())]
    rows = [(1, body), (2, f"Intro\n\n{body.upper()}\n\nEnd"), (3, body.replace("7.", "7. not")), (4, body + " x"), (5, "\n\n".join(parts[:-1]))]
    got = scan(spark.createDataFrame(rows, SCHEMA), [], digests=known).collect()
    assert sorted((r["doc_id"], r["license"], r["unit"], r["n"]) for r in got) == [(1, "MyPL-1", "paragraphs", 1), (1, "MyPL-1", "text", 1), (2, "MyPL-1", "paragraphs", 1)]


FOLDER = "/usr/share/common-licenses"
FILES = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0"}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the system has no licence texts")
def test_public_files_have_the_known_digests(spark):
    names = [n for n in FILES if os.path.exists(f"{FOLDER}/{FILES[n]}")]
    rows = []
    for i, name in enumerate(names):
        with open(f"{FOLDER}/{FILES[name]}") as f:
            rows.append((i, f.read()))
    found = {(r[0], r[1], r[2]) for r in _scan(spark, rows)}
    assert all({(i, n, "text"), (i, n, "paragraphs")} <= found for i, n in enumerate(names))
