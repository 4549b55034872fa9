"""The rule languages: parts of programs, and columns against the Python form."""

import random

import pytest

from docloom.plans import rule_columns, rules, yaml_ops


def test_yaml_columns_and_python_agree(spark):
    r = random.Random(5)
    words = ["a", "b.", " the ", "x\u3000", "", "\n", "zz"]
    texts = ["".join(r.choice(words) for _ in range(r.randint(0, 8))) for _ in range(40)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(3)
    names = ["p", "q"]

    def step(depth):
        op = r.choice(["contains", "find_after", "take_before", "copy", "restore", "set_text", "set_var", "strip", "compact_ws", "concat", "emit", "if_var", "nothing"])
        a = {"op": op}
        options = {"phrase": words, "in": ["all", "first_n"], "n": [0, 3], "set": names, "pattern": words, "into": [*names, None], "as": names, "from": names, "from_var": [*names, "un"], "literal": ["L", "", None, True, 3], "name": names, "from_text": [True, False], "var": [*names, None], "keep_spaces": [True, False], "target": names, "prefix": ["<"], "suffix": [">"], "key": ["k"], "truthy": [True], "falsy": [True]}
        for k, v in options.items():
            if r.random() < 0.5:
                a[k] = r.choice(v)
        if op == "if_var":
            a["var"] = r.choice(names)
            for k in ("equals", "not_equals"):
                if r.random() < 0.3:
                    a[k] = r.choice(["L", None, True, "a"])
            if depth:
                a["then"], a["else"] = [step(depth - 1) for _ in range(2)], [step(depth - 1)]
        return a

    for _ in range(6):
        steps = [step(1) for _ in range(10)] + [{"op": "emit", "key": n, "from_var": n} for n in names] + [{"op": "set_var", "name": "z", "from_text": True}, {"op": "emit", "key": "z", "from_var": "z"}]
        got = {}
        for x in sorted(yaml_ops.emit_rows(df, steps, "i").collect(), key=lambda x: (x["i"], x["seq"])):
            got.setdefault(x["i"], []).append((x["key"], x["value"]))
        for i, t in enumerate(texts):
            s = yaml_ops.State("", t or "")
            yaml_ops.run_steps(s, steps)
            assert got[i] == s.rows, (steps, t)


def test_printing_operations_emit_nothing():
    s = yaml_ops.State("f", "text")
    yaml_ops.run_steps(s, [{"op": "print_file_info"}, {"op": "len_print"}])
    assert s.rows == []


def test_parser_parts():
    assert rules.split_list('"zzz",') == ["zzz"]
    assert rules.split_list('"a, b" , c\\,d,') == ["a, b", "c,d"]
    assert rules.split_list("") == []
    assert rules.split_args('"a,b", "c"', 2) == ["a,b", "c"]
    assert rules.split_args('start, "x", "y,z"', 3) == ["start", "x", "y,z"]
    assert rules.unquote("'a'") == "a" and rules.unquote("'a\"") == "'a\""
    assert rules.search_escapes("a\\nb\\tc\\rd") == "a\nb\tc\\rd"
    assert rules.add_escapes("a\\n\\t\\r\\\\\\q") == "a\n\t\r\\\\q"


@pytest.mark.parametrize(
    ("script", "text", "want"),
    [
        ('v:\n    search text : ("zzz",)\n    if found :\n        set(true)\n', "abc", None),
        ('v:\n    seach text : "b"\n    if found :\n        set("x")\n', "abc", "x"),
        ('v:\n  \tsearch text : "b"\n    if found :\n\tset("x")\n', "abc", "x"),
        ('v:\n    search text : "b"\n    if found :\n        take right :\n            store(rest)\n    search in : rest\n    search text : "c"\n    if found :\n        take right :\n            set("in rest")\n            set(rest)\n', "abcd", "cd"),
        ('v:\n    set("no")\nw:\n    check : v\n    has value : "no"\n    if true :\n        set("same")\n    if false :\n        set("other")\n', "t", "no"),
        ('v:\n    search text : "a"\n    if found :\n        take right :\n            add in left("<\\n")\n            store(x)\n            add in right(x)\n            replace(end, "b", "!")\n            store(y)\n            set(y)\n', "ab", "<\nb<\n!"),
    ],
)
def test_programs(script, text, want):
    assert rules.Program(script).run(text).get("v") == want


def _random_program(r):
    """A program of a few variables with every kind of step, nested up to three deep."""
    words = ['"a"', '"b "', '"zz"', '"\\n"', '("zz", "b", "a")', '["a", "b"]', '{"zz", "b"}', '""', '"[["']
    names = ["x", "y", "v0", "v1"]

    def steps(depth, pad):
        out = []
        for _ in range(r.randint(1, 4)):
            k = r.randint(0, 15)
            if k < 4:
                out.append(f"search text : {r.choice(words)}")
            elif k == 4:
                out.append(f"search in : {r.choice(['all', 'taken', *names])}")
            elif k == 5:
                out.append(f"search in first : {r.choice(['4', '0', 'n'])}")
            elif k == 6:
                out.append(f"store({r.choice(names)})")
            elif k == 7:
                out.append("set(" + r.choice(['"lit"', "true", "false", "all", *names]) + ")")
            elif k == 8:
                out.append(r.choice(["remove whitespaces", "remove tables", "unknown"]))
            elif k == 9:
                out.append(f"add in {r.choice(['left', 'right'])}(" + r.choice(['"<"', *names]) + ")")
            elif k == 10:
                out.append("replace(" + r.choice(['"a", "A"', 'start, "a", "S"', 'end, "b", "E"', '"b ", ""']) + ")")
            elif k == 11:
                out.append(f"check : {r.choice(names)}")
                if r.random() < 0.4:
                    out.append('has value : "lit"')
            elif depth:
                head = r.choice(["if found", "if not found", "if true", "if false", "take right", "take left", "take right", "other block"])
                out.append(head + " :")
                out += steps(depth - 1, "    ")
        return [pad + x for x in out]

    return "".join(f"v{i}:\n" + "\n".join(steps(3, "    ")) + "\n" for i in range(3))


def test_rule_columns_and_python_agree(spark):
    r = random.Random(11)
    parts = ["a", "b ", " ", "\n", "　", "[[PAGE_START 1]]", "[[PAGE_START 22]]\n", "[[PAGE_END]]", "[[TABLE_START page=1]]", "[[TABLE_END]]", "1", "lit", "​", "𠮷"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(50)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").repartition(2)
    for _ in range(12):
        script = _random_program(r)
        a, b = ({x["i"]: x.asDict() for x in e(df, script).collect()} for e in (rules.extract, rule_columns.extract))
        for i, t in enumerate(texts):
            assert a[i] == b[i], (script, t)
