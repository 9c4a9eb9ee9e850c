from functools import partial
from types import SimpleNamespace

from provena.llm.license import FAMILIES, TEMPLATES, fit_licences, scan_licences, similarity
from provena.llm.queries import op10_licences

from ..conftest import SF_MID
from .cases import no_docs, odd_docs

LINES = {"All rights reserved.": "All-rights-reserved", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
         "This work is licensed under the GNU General Public License, version 3.": "GPL", "Released under the MIT License.": "MIT",
         "Licensed under CC BY-NC 4.0.": "CC-BY-NC"}


def test_query(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    want = {(d.doc_id, f) for d in docs for line, f in LINES.items() if line in d.text.split("\n")}
    got = op10_licences(spark, SF_MID).collect()
    text = {d.doc_id: d.text for d in docs}
    assert len(want) > 10 and {(r.doc_id, r.family) for r in got} == want
    for r in got:
        assert text[r.doc_id][r.start:r.end].strip(". ") in {x.strip(". ") for x in LINES}


def test_families_and_the_unknown_class(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = fit_licences(docs)
    texts = [(i, TEMPLATES[f][0]) for i, f in enumerate(FAMILIES)]
    other = ["The license plate of the general was public.", "All of the rights were reserved for the apache tribe.",
             "Copying the version 2.0 of the work under the bridge.", "word " * 500]
    inside = "one two three four " * 60 + TEMPLATES["MIT"][2] + " five six seven" * 60  # in the middle of a long line
    rows = [*texts, *((100 + i, t) for i, t in enumerate(other)), (200, inside), (201, TEMPLATES["GPL"][0] + "\n" + TEMPLATES["MIT"][0])]
    got = scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), model).where("confirmed").collect()
    found = {(r.doc_id, r.family) for r in got}
    assert {(i, f) for i, f in enumerate(FAMILIES)} <= found
    assert not {i for i, _ in found if 100 <= i < 200}
    assert (200, "MIT") in found and {(201, "GPL"), (201, "MIT")} <= found
    assert similarity("Released under the MIT License.", "MIT") == 1.0 and similarity("nothing alike here", "MIT") < 0.3


def test_odd_rows(spark):
    model = fit_licences(odd_docs(spark))
    assert scan_licences(odd_docs(spark), model).where("confirmed").count() == 0
    assert scan_licences(no_docs(spark), model).count() == 0
    assert fit_licences(no_docs(spark)) is not None  # notices and like sentences alone


def test_two_families_in_one_line(spark):
    model = fit_licences(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    t = {f: TEMPLATES[f][0] for f in FAMILIES}
    both = [("MIT", "All-rights-reserved"), ("Apache-2.0", "MIT"), ("GPL", "All-rights-reserved"), ("CC-BY-NC", "MIT"), ("BSD", "GPL"),
            ("All-rights-reserved", "Apache-2.0"), ("LGPL", "BSD")]
    rows = [(i, f"{t[a]} {t[b]}") for i, (a, b) in enumerate(both)]
    alone = [(100 + i, t[f]) for i, f in enumerate(FAMILIES)]  # no kindred family beside the right one
    got = scan_licences(spark.createDataFrame([*rows, *alone], "doc_id long, text string"), model).where("confirmed").collect()
    assert {(r.doc_id, r.family) for r in got} == ({(i, f) for i, pair in enumerate(both) for f in pair}
                                                   | {(100 + i, f) for i, f in enumerate(FAMILIES)})
    assert all((r.start, r.end) == (0, len(dict(rows + alone)[r.doc_id].rstrip("."))) for r in got)


def test_a_confirmed_window_before_a_likelier_one(spark):
    """The likelier of two overlapping windows isn't confirmed; the other is, and stays."""
    text = "twenty plain words. " + TEMPLATES["MIT"][0]
    places = [(0, 0, 20, [(0, 0.99)]), (0, 10, len(text), [(0, 0.6)])]
    model = SimpleNamespace(scan=partial(getattr, SimpleNamespace(places=places), "places"))  # whatever the texts, these places
    got = scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert [(r.start, r.end, r.family, r.confirmed) for r in got] == [(10, len(text), "MIT", True)]


def test_short_lines_confirm_nothing_and_wrapped_notices_are_one(spark):
    model = fit_licences(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    short = ["of the", "under the", "General Public", "the License", "Version 2.0", "rights reserved"]
    assert all(similarity(t, f) < 0.6 for t in short for f in FAMILIES)
    words = TEMPLATES["MIT"][2].split()
    wrapped = "\n".join(" ".join(words[i:i + 9]) for i in range(0, len(words), 9))
    commented = "\n".join(" * " + " ".join(words[i:i + 9]) for i in range(0, len(words), 9))
    rows = [*enumerate(short), (100, wrapped), (101, "/*\n" + commented + "\n */\nint main;"), (102, TEMPLATES["MIT"][0] + "\n\n" + TEMPLATES["BSD"][0])]
    got = scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), model).where("confirmed").collect()
    assert sorted((r.doc_id, r.family) for r in got) == [(100, "MIT"), (101, "MIT"), (102, "BSD"), (102, "MIT")]
