"""Flat-file records: places, qualifiers, bases and broken records."""

import random

import pytest

from loomspan.functions.sequences import CODONS
from loomspan.sources import genbank

TURN = str.maketrans("ACGT", "TGCA")


@pytest.mark.parametrize(
    "text,spans,left,right",
    [
        ("1..9", [(None, 1, 9, "+")], False, False),
        ("<5", [(None, 5, 5, "+")], True, False),
        ("complement(3..>8)", [(None, 3, 8, "-")], False, True),
        ("join(1..3,7..9)", [(None, 1, 3, "+"), (None, 7, 9, "+")], False, False),
        ("complement(join(1..3,7..9))", [(None, 7, 9, "-"), (None, 1, 3, "-")], False, False),
        ("join(complement(7..9),complement(1..3))", [(None, 7, 9, "-"), (None, 1, 3, "-")], False, False),
        ("join(AB_1.2:1..3, 7..9)", [("AB_1.2", 1, 3, "+"), (None, 7, 9, "+")], False, False),
        ("order(1^2,complement(order(4..5,complement(8..9))))", [(None, 1, 2, "+"), (None, 8, 9, "+"), (None, 4, 5, "-")], False, False),
    ],
)
def test_places(text, spans, left, right):
    assert genbank.read_place(text) == (spans, left, right)


@pytest.mark.parametrize("text", ["", "join(1..3", "join(1..3,", "9..1", "1..x", "1..3)", "complement 1..3", "join()"])
def test_broken_places(text):
    with pytest.raises(ValueError):
        genbank.read_place(text)


def record(name, seq, features, length=None):
    lines = [f"LOCUS       {name}   {length or len(seq)} bp    mRNA    linear   INV 09-FEB-2015", f"DEFINITION  A gene of {name},", "            second line.", f"ACCESSION   {name}", f"VERSION     {name}.1  GI:1", "SOURCE      thing", "  ORGANISM  Genus species", "            Kingdom; Order.", "FEATURES             Location/Qualifiers"]
    for kind, place, quals in features:
        lines.append(f"     {kind:<16}{place}")
        lines += [" " * 21 + q for q in quals]
    lines += ["ORIGIN      "]
    for i in range(0, len(seq), 60):
        lines.append(f"{i + 1:>9} " + " ".join(seq[j : j + 10].lower() for j in range(i, min(i + 60, len(seq)), 10)))
    return "\n".join([*lines, "//", ""])


def test_records_round_trip(spark, tmp_path):
    draw, text, want = random.Random(2), "", {}
    for k in range(30):
        protein = "".join(draw.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(draw.randrange(5, 60)))
        back = {a: c for c, a in CODONS.items()}
        cds = "".join(back[a] for a in protein) + "TAA"
        cut = draw.randrange(1, len(cds) - 1)
        pieces = [cds[:cut], cds[cut:]]
        seq, spans = "ACGTTG", []
        for p in pieces:
            spans.append((len(seq) + 1, len(seq) + len(p)))
            seq += p + "GTAAGTCC"
        place = ",".join(f"{b}..{e}" for b, e in spans)
        if k % 2:
            n = len(seq)
            seq = seq[::-1].translate(TURN)
            place = "complement(join(" + ",".join(f"{n - e + 1}..{n - b + 1}" for b, e in spans[::-1]) + "))"
        else:
            place = f"join({place})"
        if k % 5 == 0:
            place = place.replace("(", "(\n                     ", 1)
        quals = ['/gene="a""b"', "/codon_start=1", f'/product="long name\n{" " * 21}of two lines, join(1..2)"', "/partial", f'/protein_id="P{k}"', f'/translation="{protein[:4]}\n{" " * 21}{protein[4:]}"', '/gene="other"']
        text += record(f"R{k}", seq, [("source", f"1..{len(seq)}", ['/organism="Genus species"']), ("CDS", place, quals)])
        want[f"R{k}"] = (seq, cds, protein)
    text += record("BAD1", "ACGT", [("CDS", "join(1..2", [])]) + record("BAD2", "ACGT", [], 9) + "garbage\n//\n" + "\n\n"
    path = tmp_path / "x.gbk"
    path.write_text(text)
    rows = genbank.records(spark, str(path)).cache()
    by = {r["accession"]: r for r in rows.collect()}
    assert {k for k, r in by.items() if r["error"] is None} == {*want, "BAD1"} and by["BAD2"]["error"].startswith("4 bases") and by[None]["error"] == "no LOCUS line"
    for name, (seq, _, _) in want.items():
        r = by[name]
        assert (r["seq"], r["length"], r["version"], r["molecule"], r["definition"], r["organism"]) == (seq, len(seq), f"{name}.1", "mRNA", f"A gene of {name}, second line.", "Genus species")
    got = {r["accession"]: r for r in genbank.transcripts(rows).collect()}
    assert {k: (r["cds"], r["protein"], r["gene"], r["product"], r["complete"]) for k, r in got.items()} == {k: (c, p, 'a"b', "long name of two lines, join(1..2)", "complete") for k, (_, c, p) in want.items()}
    features = genbank.features(rows, ("CDS",)).collect()
    assert {r["accession"]: r["error"] is None for r in features} == {**dict.fromkeys(want, True), "BAD1": False}
    assert all(r["qualifiers"]["gene"] == 'a"b' and r["qualifiers"]["partial"] is None for r in features if r["error"] is None)
    assert rows.count() == 33
