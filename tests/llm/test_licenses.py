"""License lookup by canonical digest."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import licenses


def test_equivalent_texts(spark, docs, nasty):
    isc = licenses.KNOWN["ISC"]
    rows = [
        *nasty,
        (1, "Copyright (c) 2020 Somebody\n" + isc.upper().replace("\n", "  \r\n")),
        (2, isc + " or not"),
        (3, "Some prose.\n * licenced under the apache LICENCE v 2.0!\nMore prose.\nReleased under the MIT licence\nreleased under the MIT license"),
        (4, "(C) 1999\nAll rights reserved."),
        (5, licenses.KNOWN["MIT"]),
        (6, "we discuss the MIT License here"),
    ]
    df = docs(rows).withColumn("license_id", F.lit("old"))
    out = licenses.scan(df, licenses.known_licenses(spark))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "canonical_sha256", "license_id", "line_licenses", "n_license_lines"]
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows)
    assert got[1].license_id == "ISC" and got[2].license_id is None and got[5].license_id == "MIT" and got[5].line_licenses == ["MIT"]
    assert got[3].license_id is None and got[3].line_licenses == ["Apache-2.0", "MIT"] and got[3].n_license_lines == 3
    assert got[4].canonical_sha256 is None and got[900].canonical_sha256 is None and got[6].line_licenses == []
    own = spark.createDataFrame([("Z", "Hello,  World"), ("A", "hello world"), ("N", None)], "license_id string, text string")
    assert [r.license_id for r in licenses.scan(docs([(1, "HELLO world!")]), own).collect()] == ["A"]
    assert licenses.scan(docs(rows).where("false"), own).count() == 0
    assert licenses.scan(docs(rows), own.where("false")).where("license_id is not null").count() == 0


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in
all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are
met:

1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS
IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED
TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED
TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def found(spark, docs, texts):
    out = licenses.scan(docs(list(enumerate(texts))), licenses.known_licenses(spark)).collect()
    return [r.license_id for r in sorted(out, key=lambda r: r.doc_id)]


def test_full_texts(spark, docs):
    third = BSD[BSD.index("3. Neither") : BSD.index("THIS SOFTWARE IS")]
    two = BSD.replace(third, "")
    texts = [MIT, "The MIT License (MIT)\n\nCopyright (c) 2020 Somebody\n\n" + MIT, MIT + "\nNot for evil.", BSD, "BSD 3-Clause License\n\nCopyright (c) 2020, Somebody\nAll rights reserved.\n\n" + BSD.replace("3. ", "* ").replace("2. ", "* ").replace("1. ", "* ")]
    texts += [two, "BSD 2-Clause License\nCopyright 2020 Somebody\n" + two, MIT[: len(MIT) // 2]]
    assert found(spark, docs, texts) == ["MIT", "MIT", None, "BSD-3-Clause", "BSD-3-Clause", "BSD-2-Clause", "BSD-2-Clause", None]
    out = licenses.scan(docs([(1, MIT), (2, "prose")]), licenses.known_licenses(spark)).collect()
    assert {r.doc_id: (r.line_licenses, r.n_license_lines) for r in out} == {1: ([], 0), 2: ([], 0)}


def test_long_texts_of_the_system(spark, docs):
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    if not all((folder / n).exists() for n in names):
        pytest.skip("no license texts on this system")
    texts = [(folder / n).read_text() for n in names]
    assert found(spark, docs, texts) == list(names.values())
    apache = texts[0][: texts[0].index("APPENDIX")]
    assert found(spark, docs, [apache, apache[apache.index("TERMS AND CONDITIONS FOR") :], apache[:5000]]) == ["Apache-2.0", "Apache-2.0", None]
