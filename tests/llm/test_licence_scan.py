import hashlib
import pathlib
import re

import pytest

from inkwell.llm import licence_texts
from inkwell.llm.licence_scan import licence_scan
from inkwell.llm.licence_texts import KNOWN_TEXTS
from tests.llm.helpers import documents

EMPTY = hashlib.sha256(b"").hexdigest()


def rows(df):
    return {r["doc_id"]: (r["licence"], r["notices"]) for r in df.collect()}


def test_every_known_text_is_found(spark):
    got = rows(licence_scan(documents(spark, [(i, t) for i, (_, t) in enumerate(KNOWN_TEXTS)])))
    assert [got[i][0] for i in range(len(KNOWN_TEXTS))] == [name for name, _ in KNOWN_TEXTS]


@pytest.mark.parametrize("change", [
    lambda t: t.upper(), lambda t: t.replace(",", " ;"), lambda t: "Copyright (c) 2020 Some One\n\n" + t,
    lambda t: "© 2019 A. B.\nCopyright 2020, C\nAll rights reserved.\n" + t, lambda t: t.replace("\n", "\n   * "),
    lambda t: t.replace("sublicense", "sub-licence"), lambda t: t.replace("HOLDERS", "OWNERS")])
def test_changes_that_do_not_count(spark, change):
    mit = KNOWN_TEXTS[0][1]
    assert rows(licence_scan(documents(spark, [(1, change(mit))])))[1][0] == "MIT"


def test_near_misses_and_notices(spark):
    mit = KNOWN_TEXTS[0][1]
    got = rows(licence_scan(documents(spark, [
        (1, mit + " no"), (2, "Some prose.\nreleased under the MIT licence\nLicensed under CC-BY-NC 4.0"),
        (3, "Not released under the MIT License.")])))
    assert got == {1: (None, ""), 2: (None, "CC-BY-NC-4.0,MIT"), 3: (None, "")}


def test_nulls_empties_long_repeats_and_clashing_columns(spark):
    long = "word " * 400_000
    df = documents(spark, [(None, None), (1, ""), (2, long), (2, long), (3, "*** \n\n")], digest="x", lines="y",
                   licence="z", known_digest="k")
    got = licence_scan(df).collect()
    assert len(got) == 5 and {r["licence"] for r in got} == {None}
    assert sorted(r["digest"] == EMPTY for r in got) == [False, False, True, True, True]
    assert licence_scan(df.limit(0)).count() == 0


def test_whole_texts_and_usual_notices(spark):
    folder = pathlib.Path("/usr/share/common-licenses")
    whole = [("GPL-3", "GPL-3.0-only"), ("Apache-2.0", "Apache-2.0"), ("LGPL-2.1", "LGPL-2.1-only"), ("MPL-2.0", "MPL-2.0")]
    given = [(name, (folder / file).read_text()) for file, name in whole if (folder / file).exists()]
    given += [(name, "   " + text.upper().replace("LICENSE", "LICENCE")) for name, text in licence_texts.whole_texts()]
    got = rows(licence_scan(documents(spark, [(i, t) for i, (_, t) in enumerate(given)])))
    assert [got[i][0] for i in range(len(given))] == [name for name, _ in given]
    lines = {"Licensed under the GPL, version 3": "GPL-3.0-only", "SPDX-License-Identifier: MPL-2.0": "MPL-2.0",
             "Licensed under the Mozilla Public Licence, v. 2.0.": "MPL-2.0", "SPDX-License-Identifier: AGPL-3.0-or-later": "AGPL-3.0-or-later",
             "This program is licensed under the GNU General Public License version 2 or any later version.": "GPL-2.0-or-later",
             "Released under CC-BY-NC-SA 4.0": "CC-BY-NC-SA-4.0", "Available under the Apache 2.0 license": "Apache-2.0"}
    got = rows(licence_scan(documents(spark, [(i, "Some prose.\n" + t) for i, t in enumerate(lines)])))
    assert [got[i] for i in range(len(lines))] == [(None, name) for name in lines.values()]


def test_one_licence_a_digest(spark):
    from inkwell.llm.licence_scan import known_licences
    known = {}
    for name, text in KNOWN_TEXTS:
        key = " ".join(re.sub(r"[^a-z0-9.]+", " ", text.lower()).split())
        assert known.setdefault(key, name) == name
    assert known_licences(spark).count() > 800
