"""The lexical mask against a reader that goes character by character, and modules found on it."""

import random

import pytest
from pyspark.sql import functions as F

from corpusmill.functions.lexical import mask, spans
from corpusmill.operators import parse


def painted(text):
    out, i = [], 0
    while i < len(text):
        j = i + 1
        if text.startswith("//", i):
            j = text.find("\n", i)
            j, fill = (len(text) if j < 0 else j), " "
        elif text.startswith("/*", i):
            j = text.find("*/", i + 2)
            j, fill = (len(text) if j < 0 else j + 2), " "
        elif text[i] == '"':
            fill = '"'
            while j < len(text) and text[j] not in '"\n':
                if text[j] == "\\" and j + 1 == len(text):
                    break
                j += 2 if text[j] == "\\" else 1
            if j < len(text) and text[j] == '"':
                j += 1
        elif text[i] == "\\" and j < len(text) and text[j] not in " \n\t":
            fill = "_"
            while j < len(text) and text[j] not in " \n\t":
                j += 1
        else:
            fill = text[i]
        out.append(fill * (j - i))
        i = j
    return "".join(out)


def test_random_texts(spark):
    draw = random.Random(5)
    bits = ['"', "\\", "\\\n", "//", "/*", "*/", "/", "*", "\n", " ", "a", "é\U0001f600", "module x", "endmodule"]
    texts = ["".join(draw.choices(bits, k=draw.randint(0, 14))) for _ in range(3000)]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for row in table.select("i", "t", mask(F.col("t")).alias("m")).collect():
        assert row.m == painted(row.t), row.t
        assert len(row.m) == len(row.t)
    assert table.limit(1).select(mask(F.lit(None).cast("string"))).first()[0] is None


def test_spans(spark):
    got = spark.range(1).select(spans(F.lit("xx aab é aaab ab"), "a+b").alias("s")).first()["s"]
    assert [tuple(s) for s in got] == [(4, 3), (10, 4), (15, 2)]


LONG = "/* " + "endmodule module q; " * 20_000 + "*/"


@pytest.mark.parametrize(
    "text, want",
    [
        ("module a; // endmodule\n x; endmodule y", [("a", "module a; // endmodule\n x; endmodule")]),
        ('module a; s = "endmodule \\" endmodule"; endmodule', [("a", 'module a; s = "endmodule \\" endmodule"; endmodule')]),
        ("// module no; endmodule\nmodule a; endmodule", [("a", "module a; endmodule")]),
        ("module /* module b */ a; endmodule module \\c+d (x); wire \\endmodule ; endmodule",
         [("a", "module /* module b */ a; endmodule"), ("c+d", "module \\c+d (x); wire \\endmodule ; endmodule")]),
        ("module a; /* endmodule", [(None, "module a; /* endmodule")]),
        ("é\U0001f600 module a; endmodule", [("a", "module a; endmodule")]),
        (f"module a; {LONG} endmodule", [("a", f"module a; {LONG} endmodule")]),
        ("", [(None, "")]),
    ],
)
def test_modules(spark, text, want):
    files = spark.createDataFrame([(0, "sv", "r/a.sv", text)], "ext_rank int, ext string, path string, content string")
    rows = parse.sv_modules(files, masked=True).orderBy("pos").collect()
    assert [(r.module_name, r.content) for r in rows] == want
    assert all((r.type == "sv_module") == (name is not None) for r, (name, _) in zip(rows, want))


def test_plain_code_is_the_same_either_way(spark):
    text = "`x\nmodule a (input b);\n assign c = a / b;\nendmodule\nmodule d; endmodule // end"
    files = spark.createDataFrame([(0, "sv", "r/a.sv", text), (3, "md", "r/n.md", "# T\nx")],
                                  "ext_rank int, ext string, path string, content string")
    plain, masked = (sorted(map(str, parse.raw_records(files, m).collect())) for m in (False, True))
    assert plain == masked and len(plain) == 3
