"""Paragraphs of several lines without a template, whole licence texts, and the classifier on wordings it hasn't seen."""

import re
import textwrap

import numpy as np
import pytest

from claimlake.llm import licences as lic

ORDINARY = ["plain prose of the day", "a thing in the way of this work and that"]
MODEL = lic.train(ORDINARY)
UNKNOWN = "This file is distributed under the terms of the Brumelo Community Source License, version 4.0, which the licensor grants to the user."


def brief(text):
    return [(f[0], f[1], f[4]) for f in MODEL.findings(text)]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "dnl "])
@pytest.mark.parametrize("width", [30, 45, 60])
def test_a_wrapped_notice_of_no_family_is_one_finding(width, mark):
    lines = [mark + x for x in textwrap.wrap(UNKNOWN, width)]
    assert len(lines) > 2
    assert brief("\n".join(lines)) == [(0, lic.UNKNOWN, False)]
    assert brief("\n".join(["qqq zzz.", "", *lines, "qqq zzz.", *lines, "zzz"])) == [(1, lic.UNKNOWN, False), (2 + len(lines), lic.UNKNOWN, False)]


def test_a_paragraph_is_judged_by_all_its_lines():
    text = "You may use what is\nin here just as the Apache License\nVersion 2.0 of the foundation has it"
    assert [f[1] for f in MODEL.findings(text)] == ["apache-2.0"]


def test_sentence_ends_blank_lines_and_confirmed_lines_part_paragraphs():
    one = "Licensed under the Quux Source License 9"
    assert brief(f"{one}.\n{one}.\n\n{one}\n\n{one}") == [(n, lic.UNKNOWN, False) for n in range(4)]
    assert brief(f"{one}\nReleased under the MIT License\n{one}") == [(0, lic.UNKNOWN, False), (1, "mit", True), (2, lic.UNKNOWN, False)]
    assert brief(f"{one}\n{one}\n{one}") == [(0, lic.UNKNOWN, False)]
    assert brief("\n".join([one, *["zzz"] * lic.GAP, one])) == [(0, lic.UNKNOWN, False)]
    assert brief("\n".join([one, *["zzz"] * (lic.GAP + 1), one])) == [(0, lic.UNKNOWN, False), (lic.GAP + 2, lic.UNKNOWN, False)]


def test_ordinary_lines_give_nothing_joined():
    assert MODEL.findings("\n".join(["the version of the work", "of the day in a general way"] * 200)) == []
    assert MODEL.findings("") == [] and MODEL.findings("\n\n") == []


def test_whole_licence_texts_are_confirmed_paragraph_by_paragraph():
    for family in ("mit", "bsd", "isc", "apache-2.0"):
        notices = [t for t in lic.TEMPLATES[family] if len(t) > 100]
        text = "\n\n".join("\n".join(textwrap.wrap(t, 72)) for t in notices)
        assert [(f[1], f[4]) for f in MODEL.findings(text)] == [(family, True)] * len(notices)


def test_the_line_finders_match_as_a_plain_list_of_ngrams_does():
    for model in (MODEL, lic.train(sorted({w for v in lic.TEMPLATES.values() for x in v for w in lic.words(x)}))):
        least = sorted((g for g in model.features if lic._least(g, model.features)), key=len, reverse=True)
        text = "\n".join([x for v in lic.TEMPLATES.values() for x in v] + [UNKNOWN, "gplv3 gplv2x agplv3\ncc by\n\nsa the\nmit-license"]).lower()
        for got, gap in ((model.finder, r"[^a-z0-9\n]+"), (model.across, "[^a-z0-9]+")):
            plain = re.compile(r"(?<![a-z0-9])(?:" + "|".join(g.replace(" ", gap) for g in least) + r")(?![a-z0-9])")
            assert [m.span() for m in got.finditer(text)] == [m.span() for m in plain.finditer(text)]


def test_recall_of_each_family_and_calibration_on_unseen_wordings():
    """Words left out at random, words around them. Recall counts wordings that still hold an n-gram of
    their family alone: without its version, say, a notice is of no family for certain."""
    rng = np.random.default_rng(7)
    filler = "zor mek tal bin quo ras del vum".split()
    held = {k: {g for t in v for g in lic.grams(t)} for k, v in lic.TEMPLATES.items()}
    sure, right, every = [], [], []
    for family, notices in lic.TEMPLATES.items():
        others = set().union(*(g for k, g in held.items() if k != family))
        seen = [v for n in notices for v in lic._variations(n, filler, rng, 40)[1:]]
        telling = [bool(lic.grams(v) & (held[family] - others)) for v in seen]
        hits = [bool(j) and j[0] == family for j in map(MODEL.judge, seen)]
        recall = np.mean([h for h, t in zip(hits, telling) if t])
        print(family, round(float(recall), 3), "of all", round(float(np.mean(hits)), 3))
        assert recall >= 0.9, family
        every += hits
        for v in seen:
            p = MODEL.probabilities(v)
            sure.append(float(p.max()))
            right.append(MODEL.classes[int(p.argmax())] == family)
    sure, right = np.array(sure), np.array(right)
    bins = np.minimum((sure * 10).astype(int), 9)
    error = sum(abs(sure[bins == b].mean() - right[bins == b].mean()) * (bins == b).mean() for b in set(bins.tolist()))
    print("calibration error", round(float(error), 3), "accuracy", round(float(right.mean()), 3), "recall", round(float(np.mean(every)), 3))
    assert error < 0.1
