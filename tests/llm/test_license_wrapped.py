"""Notices that are wrapped over lines, as source headers have them."""

import random
import textwrap

import pytest

from quiremill.llm import license_scan
from test_llm_small import prose

HEADERS = {
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy and modify it.',
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
}


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return license_scan.Model([prose(rng, 12) for _ in range(200)])


@pytest.mark.parametrize("family", sorted(HEADERS))
@pytest.mark.parametrize(("width", "lead"), [(72, ""), (60, " * "), (40, "# ")])
def test_wrapped_header(model, family, width, lead):
    header = "\n".join(lead + x for x in textwrap.wrap(HEADERS[family], width))
    text = f"{prose(random.Random(4), 30)}\n{lead.rstrip()}\n{header}\n\n{prose(random.Random(5), 30)}"
    found = model.scan(text)
    assert {s["family"] for s in found} == {family}
    assert all(text.index(header) <= s["start"] < s["end"] <= text.index(header) + len(header) for s in found)


def test_lines_of_one_paragraph_stay_apart(model):
    text = "Released under the MIT License.\nLicensed under the Zorblax License.\nplain words\nLicensed under CC BY-NC 4.0."
    found = model.scan(text)
    assert [(s["paragraph"], s["family"]) for s in found] == [(0, "mit"), (1, "unknown"), (3, "cc-by-nc")]
    assert [text[s["start"] : s["end"]] for s in found][0] == "Released under the MIT License"
