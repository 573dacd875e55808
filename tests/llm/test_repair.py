import hashlib
import random
import zlib

import pytest

from stayline.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = set(" \t\n\x0b\x0c\r")


def least(kinds, costs=repair.COSTS):
    """Cost and audit by going through every place and state, up to three insertions at each."""
    stay = repair.insertions(costs)

    def inserted(labels):
        for _ in range(3):
            for p, q, price, name in stay:
                if p in labels:
                    label = (labels[p][0] + price, labels[p][1] + name)
                    labels[q] = min(labels.get(q, label), label)
        return labels

    labels = inserted({repair.START: (0, "")})
    for kind in kinds:
        after = {}
        for p, q, price, name in repair.row_steps(kind, costs):
            if p in labels:
                label = (labels[p][0] + price, labels[p][1] + name)
                after[q] = min(after.get(q, label), label)
        labels = inserted(after)
    return min(labels[p] for p in repair.FINAL if p in labels)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def brute_force(rows, original):
    out = {}
    for conv in {r[0] for r in original}:
        def place(r):
            return (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest())

        mine = sorted((r for r in rows if r[0] == conv), key=place)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        kinds, counts, seen = [], [0, 0, 0], set()
        for _, _, role, text in mine:
            kept = [c for c in text if c not in SPACES]
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not kept or (role, text) in seen:
                counts[0 if not kept else 1] += 1
                kinds.append("D")
            elif kept[-1] not in ".!?":
                counts[2] += 1
                kinds.append(initial.upper())
            else:
                kinds.append(initial)
            seen.add((role, text))
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = least(kinds) if mine else (0, "")
        said, at = [], 0
        for edit in audit:
            due = "assistant" if said and said[-1][0][0] == "u" else "user"
            if edit != "I":
                _, _, role, text = mine[at]
                at += 1
            if edit != "D":
                said.append((role, text) if edit == "K" else (due, "" if edit == "I" else text))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return out


def conversations(seed, count, longest):
    draw, rows = random.Random(seed), []
    for conv in range(count):
        for turn in range(draw.randint(1, longest)):
            role = draw.choices(["system" if turn == 0 else "user" if turn % 2 else "assistant", "user", "assistant", "system", "tool", "", None], [20, 2, 2, 1, 1, 1, 1])[0]
            text = draw.choice([f"Say {turn}.", "Yes.", "What then?", "cut off", "No! ", "", " \n", None, "é…", f"Line\n{turn}!"])
            rows.append((conv, draw.choices([turn, None, turn + 3], [20, 1, 1])[0], role, text))
    return rows


def found(frame):
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


@pytest.mark.parametrize("costs", [repair.COSTS, repair.Costs(1, 1, 1, 0), repair.Costs(3, 7, 1, 2), repair.Costs(0, 0, 2, 0), repair.Costs(2, 2, 2, 2)])
def test_both_ends_meet_at_the_cheapest_and_least_audit(costs):
    draw = random.Random(3)
    steps, stay = {k: repair.row_steps(k, costs) for k in "suaoSUAOD"}, repair.insertions(costs)
    for _ in range(400):
        kinds = draw.choices("suaoSUAOD", [2, 6, 6, 1, 1, 2, 2, 1, 2], k=draw.randint(0, 14))
        rows = [steps[k] for k in kinds]
        assert repair.cheapest(rows, stay, repair.START, repair.FINAL) == least(kinds, costs)
        size = draw.randint(1, 4)
        pieces = [repair.between_states(rows[i : i + size], stay) for i in range(0, len(rows), size)]
        assert repair.joined(pieces or [repair.between_states([], stay)]) == least(kinds, costs)


def test_long_conversations_are_put_together_from_pieces():
    draw = random.Random(8)
    kinds = draw.choices("suaoSUAOD", [1, 9, 9, 1, 1, 1, 1, 1, 2], k=5000)
    stay, steps = repair.insertions(), {k: repair.row_steps(k) for k in "suaoSUAOD"}
    pieces = [repair.between_states([steps[k] for k in kinds[i : i + 64]], stay) for i in range(0, len(kinds), 64)]
    assert repair.joined(pieces) == least(kinds)


@pytest.mark.parametrize("piece", [128, 3])
def test_damaged_conversations(spark, piece, monkeypatch):
    monkeypatch.setattr(repair, "PIECE", piece)
    monkeypatch.setattr(repair, "FAN", 2)
    rows = [*conversations(1, 60, 8), *[(900, t, "user" if t % 2 else "assistant", f"Turn {t % 90}.") for t in range(400)]]
    frame = spark.createDataFrame(random.Random(2).sample(rows, len(rows)), SCHEMA).repartition(5)
    assert found(repair.repair(repair.damaged(frame))) == brute_force(damage(rows), rows)


def test_without_damage_good_conversations_stay(spark):
    rows = [(c, t, ("system", "user", "assistant")[t if t < 2 else 2 - t % 2 if t % 2 else 2], f"Text {t}.") for c in range(5) for t in range(3)]
    for line in repair.repair(spark.createDataFrame(rows, SCHEMA)).collect():
        assert (line.gaps, line.blank, line.duplicate, line.truncated, line.illegal, line.cost, line.audit) == (0, 0, 0, 0, 0, 0, "KKK")
        assert line.repaired_sha256 == hashlib.sha256(b"system:Text 0.\nuser:Text 1.\nassistant:Text 2.").hexdigest()


def test_one_conversation_of_equal_and_of_null_rows(spark):
    rows = [(None, None, "user", "Same.")] * 700 + [(None, t, "assistant", "Same.") for t in range(300)] + [(1, None, None, None), (2, 5, "system", "Only.")]
    assert found(repair.repair(spark.createDataFrame(rows, SCHEMA))) == brute_force([(c, t, r or " ", x or " ") for c, t, r, x in rows], rows)


def test_odd_rows_empty_tables_and_clashing_names(spark):
    long = "many words " * 100_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "."), (2, 0, "", ""), (3, 0, "user", "a b "), (4, 1, "Übel", "Ü."), (5, 0, "user", "x.\x1c")]
    frame = spark.createDataFrame(rows, SCHEMA)
    clashing = frame.selectExpr("*", *[f"'own' AS {c}" for c in ("key", "kind", "first", "fresh", "part", "piece", "whole", "audit", "cost", "c", "k", "head", "line", "blank", "initial", "found")])
    assert found(repair.repair(clashing)) == brute_force(rows, rows)
    assert repair.repair(spark.createDataFrame([], SCHEMA)).count() == 0
    assert repair.repair(repair.damaged(spark.createDataFrame([], SCHEMA))).columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    with pytest.raises(ValueError):
        repair.Costs(insert=0)
