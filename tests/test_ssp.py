"""Pointings with their own lists, against the rules one file at a time."""

from pyspark.sql import functions as F

from skyplan import ssp
from skyplan.operators import triples
from skyplan.sources.datasource import write_pointing_tables

CATALOGS = {"science": (1, 2), "sky": (3,), "fluxstd": (4,)}
CLASSES = {"int": "bigint", "float": "double", "str": "string"}


def lists(spark, kind, code, wg="CO", rows=2, drop=(), **given):
    """A clean list, but for the columns given (a value of each row)."""
    fields = [x.split() for x in triples.EXPECTED[kind].split(", ")]
    clean = {"target_type_id": {"science": 1, "sky": 2, "fluxstd": 3}[kind], "input_catalog_id": CATALOGS[kind][0], "proposal_id": "S", "epoch": "J2000.0"}
    out = []
    for k in range(rows):
        row = {c: k + 1 if t == "int" else 0.5 if t == "float" else (f"{c[-1]}_ps1" if c.startswith("filter") else f"o{k}") for c, t in fields}
        out.append(row | clean | {c: v[k] for c, v in given.items()})
    fields += [[c, "float"] for c in given if c not in dict(fields)]
    names = [(c, t) for c, t in fields if c not in drop]
    df = spark.createDataFrame([tuple(r[c] for c, _ in names) for r in out], ", ".join(f"{c} {CLASSES[t]}" for c, t in names))
    return df.withColumns({"wg": F.lit(wg), "kind": F.lit(kind), "ppc_code": F.lit(code)})


def test_rules_and_dropped_pointings(spark, tmp_path):
    root = str(tmp_path / "targets")
    nan = float("nan")
    for df in [
        lists(spark, "science", "good"), lists(spark, "sky", "good"), lists(spark, "fluxstd", "good"),
        lists(spark, "science", "bad", drop=("total_flux_g", "pfi_X"), psf_flux_g=(2.0, 0.0), total_flux_r=(0.0, nan), total_flux_i=(-1.0, 0.0), total_flux_z=(0.0, 0.0), total_flux_y=(nan, nan),
              filter_g=("g_hsc", "old"), filter_r=(None, "None"), pmra=(nan, 0.0), obj_id=(7, 7), ob_code=("x", "x"), proposal_id=("T", "T"), target_type_id=(1, 3), input_catalog_id=(9, 2)),
        lists(spark, "sky", "bad", cobraId=(4, 4)), lists(spark, "fluxstd", "bad", psf_flux_z=(1.0, nan), prob_f_star=(None, 0.1)),
        lists(spark, "science", "part"), lists(spark, "fluxstd", "part"),
        *[lists(spark, kind, "blind", "GA") for kind in triples.KINDS], lists(spark, "science", "later", cobraId=(1, 1)),
    ]:
        write_pointing_tables(df, root)
    head = "ppc_code ppc_ra ppc_dec ppc_pa ppc_resolution ppc_obstime ppc_exptime ppc_nframes"
    (tmp_path / "targets/CO/ppcList.ecsv").write_text(f'{head}\ngood 1.0 2.0 0.0 L "2025-01-01 20:00:00" 900.0 3\nbad 1.0 2.0 0.0 L "2025-01-01 21:00:00" 900.0 1\npart 1.0 2.0 0.0 L 2025-01-01T22:00:00 900.0 2\nlater 1.0 2.0 0.0 L NaN 900.0 2\n')
    (tmp_path / "targets/GA/ppcList.ecsv").write_text(f"{head}\nblind 1.0 2.0 0.0 L 2025-01-01T23:00:00 900.0 2\n")
    stars = spark.createDataFrame([(c, k) for c in ("good", "bad", "part") for k in range(6 if c != "bad" else 4)], "ppc_code string, cam int")
    out = ssp.run(spark, root, stars, str(tmp_path / "out"), ["S"], CATALOGS)
    assert tuple(out) == ssp.STEPS
    assert sorted(r.ppc_code for r in out["pointings"].collect()) == ["bad", "good"]
    assert sorted((r.ppc_code, r.n_frames) for r in out["frames"].collect()) == [("bad", 2), ("good", 3)]
    got = sorted((r.ppc_code, r.kind, r.rule, r.item, r.n) for r in out["violations"].collect())
    assert got == sorted([
        ("bad", "ppc", "nframes", "1", 1), ("bad", "ppc", "cameras_without_star", "2 of 6", 2), ("blind", "ppc", "cameras_without_star", "6 of 6", 6), ("part", "sky", "missing_file", "sky", 1),
        ("bad", "science", "required_column", "pfi_X", 1), ("bad", "science", "missing_value", "pmra", 1), ("bad", "fluxstd", "missing_value", "prob_f_star", 1), ("bad", "science", "filter_name", "filter_g=old", 1),
        ("bad", "science", "flux", "total", 1), ("bad", "fluxstd", "flux", "psf", 1), ("bad", "science", "duplicate", "obj_id=7", 2), ("bad", "science", "duplicate", "ob_code=x", 2), ("bad", "sky", "duplicate", "cobraId=4", 2),
        ("bad", "science", "proposal", "T", 2), ("bad", "science", "absent_proposal", "S", 1), ("bad", "science", "target_type", "3", 1), ("bad", "science", "catalog", "9", 1),
    ])
    bad = out["targets"].where("ppc_code = 'bad' and kind = 'science'").orderBy("cidx").collect()
    assert [(r.cidx, r.total_flux_g) for r in bad] == [(0, 2.0), (1, 0.0)]
    ga = ssp.run(spark, root, stars, str(tmp_path / "ga"), ["S"], CATALOGS, groups=["GA"])
    assert ga["targets"].select("wg").distinct().collect() == [("GA",)] and ga["pointings"].count() == 0
