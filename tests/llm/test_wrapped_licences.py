"""Notices wrapped over lines, as they stand in source files, and n-grams that straddle lines."""

import textwrap

import pytest

from claimlake.llm import licences as lic

MODEL = lic.train(["plain prose of the day", "a thing in the way of this work and that"])
GPL3 = """\
This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
MIT = """\
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"""
BSD = """\
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""


def confirmed(text):
    return [(f[0], f[1]) for f in MODEL.findings(text) if f[4]]


@pytest.mark.parametrize("family,notice", [("gpl-3.0", GPL3), ("gpl-2.0", GPL3.replace("3 of", "2 of").replace("software:", "software;")), ("mit", MIT), ("bsd", BSD)])
@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "dnl "])
def test_wrapped_headers_are_confirmed(family, notice, mark):
    marked = "\n".join(mark + x for x in notice.split("\n"))
    assert confirmed(marked) == [(0, family)]
    assert confirmed(f"a title\n\nqqq zzz\n{marked}\nqqq zzz\n\nend") == [(2, family)]
    prose = "\n".join(["zzz qqq of the day in the way"] * 300)
    assert confirmed(f"{prose}\n{marked}\n{prose}\n{marked}\n{prose}") == [(300, family), (600 + len(notice.split("\n")), family)]


@pytest.mark.parametrize("width", [8, 20, 40, 75])
def test_any_width_of_lines(width):
    for family, notice in (("gpl-3.0", GPL3), ("mit", MIT), ("bsd", BSD)):
        assert confirmed("\n".join(textwrap.wrap(" ".join(notice.split()), width, break_long_words=False))) == [(0, family)]


def test_blank_lines_part_notices_and_single_lines_stay():
    assert confirmed(GPL3.replace("\n", "\n\n")) == []
    assert confirmed("Released under the MIT License.\nReleased under the MIT License.\nzzz") == [(0, "mit"), (1, "mit")]
    assert confirmed(f"Released under the MIT License.\n{MIT}") == [(0, "mit"), (1, "mit")]


def test_line_breaks_within_ngrams_leave_the_lines_apart():
    # all single words are ordinary, so that n-grams of two and three words are the least features
    every = sorted({w for notices in (*lic.TEMPLATES.values(), lic.OTHERS) for x in notices for w in lic.words(x)})
    model = lic.train(every)
    assert not any(" " not in g for g in model.features)
    assert "free software" in model.features and "software foundation" in model.features
    for text in (
        "it is free\nsoftware foundation x\nqqq\nfree software",
        "free software is free\nsoftware foundation x\nzz\nsoftware foundation",
        "under the mit\nlicense\n\nunder the mit license\nreleased under\nthe mit license of\nthe free\nsoftware foundation",
        "public\nlicense version\n3\ngeneral public\n\nlicense version 3",
    ):
        lines = [x for x in text.split("\n") if x.strip()]
        assert list(model.paragraphs(text)) == [(i, x) for i, x in enumerate(lines) if any(g in model.features for g in lic.grams(x))]
