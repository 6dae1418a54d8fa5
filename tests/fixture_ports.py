"""A small port master in the three shapes that matter: pair, rotation and NOR only."""

PORT_SCHEMA = (
    "eqp_id string, eqp_chamber_id string, eqp_chamber_posn string, eqp_posn string, seqp_type string, "
    "seqp_maker string, seqp_model_code string, seqp_id string, seqp_ch string, seqp_port string"
)
ORG_SCHEMA = (
    "eqp_id string, team_code string, division_code string, site_code string, line_code string, area_code string"
)


def pump(eqp, chamber, posn, n, maker):
    return (eqp, chamber, posn, "0", "PUMP", maker, None, f"{eqp}_PP{n:02d}", "0", "0")


def scrub(eqp, chamber, posn, role, unit, maker, ch="1", port="1"):
    return (eqp, chamber, posn, role, "SCRUBBER", maker, None, f"{eqp}_SC{unit:02d}", ch, port)


def pair():
    out = [pump("AX10", "0", "LL1", 1, "MK1"), pump("AX10", "0", "TM", 2, "MK1")]
    n = 2
    for chamber, nor, byp in (("A", 1, 2), ("B", 2, 1)):
        for posn in ("PED", "PRO"):
            n += 1
            out += [
                pump("AX10", chamber, posn, n, "MK2"),
                scrub("AX10", chamber, posn, "NOR", nor, "MK3", port=f"{n}"),
                scrub("AX10", chamber, posn, "BYP", byp, "MK3", port=f"{n}"),
            ]
    return out


def rotation():
    out = [pump("BX20", "0", "LL1", 1, "MK4"), pump("BX20", "0", "TM", 2, "MK4")]
    units = {("1", "PRO"): 1, ("2", "PRO"): 2, ("3", "PRO"): 3, ("1", "DIVERT"): 4, ("2", "DIVERT"): 5, ("3", "DIVERT"): 6}
    after = {"1": "2", "2": "3", "3": "1"}
    for n, ((chamber, posn), unit) in enumerate(units.items(), start=3):
        out += [
            pump("BX20", chamber, posn, n, "MK2"),
            scrub("BX20", chamber, posn, "NOR", unit, "MK3"),
            scrub("BX20", chamber, posn, "BYP", units[after[chamber], posn], "MK3", port="3"),
        ]
    return out


def nor_only():
    out = [pump("CX30", "0", "TM", 1, "MK4")]
    for n in range(1, 7):
        out += [pump("CX30", str(n), "PRO", n + 1, "MK5"), scrub("CX30", str(n), "PRO", "NOR", (n + 1) // 2, "MK6")]
    return out


def golden():
    return pair() + rotation() + nor_only()


def org(*eqps):
    return [(e, "T1", "D1", "P1", "L1", "A1") for e in eqps]
