import textwrap

import pytest

from ratepanel.llm import licences


def wrapped(title, owner, body):
    return f"{title}\n\n{owner}\n\n" + textwrap.fill(body, 78) + "\n"


def full(name):
    return (licences.TEXTS / f"{name}.txt").read_text(encoding="utf-8")


MIT, ISC = (max(licences.KNOWN[k], key=len) for k in ("MIT", "ISC"))


@pytest.mark.parametrize("width", [40, 78, 120])
def test_files_as_they_usually_are(spark, width):
    texts = {
        "MIT": f"MIT License\n\nCopyright (c) 2021 A. Person\n\n{textwrap.fill(MIT, width)}\n",
        "ISC": f"ISC License\n\nCopyright 2021 A. Person\n\n{textwrap.fill(ISC, width)}\n",
        "BSD-3-Clause": "BSD 3-Clause License\n\nCopyright (c) 2021, A. Person\nAll rights reserved.\n\n"
        + textwrap.fill(full("BSD-3-Clause")[full("BSD-3-Clause").index("Redistribution") :], width),
        "Apache-2.0": full("Apache-2.0").split("APPENDIX:")[0],
        **{name: full(name) for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "Unlicense", "BSD-2-Clause")},
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = {r.doc_id: r.licence for r in licences.scan(docs, licences.built_in(spark)).collect()}
    assert got == {name: name for name in texts}


def test_a_line_of_the_body_is_no_copyright_line(spark):
    lines = ["copyright notice and this permission notice appear in all", "(c) You must retain all notices", "Copyright (c) A", "© 2020 B", "Copyright 2020 C"]
    docs = spark.createDataFrame([(x,) for x in lines], "text string")
    got = [r[0] for r in docs.select(licences.canonical(docs.text)).collect()]
    assert got == [lines[0], "c you must retain all notices", "", "", ""]
