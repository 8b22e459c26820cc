"""Customer plan: reference-compatible hashes and multi-day behaviour."""

import hashlib

from pyspark.sql import functions as F

from lakevault.operators import LoadContext
from lakevault.plans import customer as cust
from lakevault.plans.testdata import customer_snapshot
from lakevault.sources.tables import read_state, read_table

from conftest import SF_SMALL


def test_compatible_hashes_with_empty_separator(spark):
    snap = customer_snapshot(spark, SF_SMALL).filter(F.col("customer_id") == 5)
    src = snap.first()
    g = cust.general_stage(snap, sep="").first()
    attrs = [src["first_name"].strip() or "No Registra", src["last_name"].strip(), src["street"], src["city"],
             src["state"], str(src["zip_code"])]
    material = str(src["customer_id"]) + "".join(attrs)
    assert bytes(g[cust.HK]) == hashlib.sha256(b"5").hexdigest().encode()
    assert bytes(g[cust.HD]) == hashlib.sha512(material.encode()).hexdigest().encode()

    p = cust.phone_stage(snap, sep="").first()
    phone = src["phone"]
    pos = phone.index(")") + 1
    area, rest = phone[:pos], phone[pos:pos + 25].replace("-", "")
    assert p[cust.PHONE_CODE] == area
    assert bytes(p[cust.HD]) == hashlib.sha512(("5" + area + rest).encode()).hexdigest().encode()

    e = cust.email_stage(snap, sep="").first()
    assert bytes(e[cust.HD]) == hashlib.sha512(("5" + src["email"]).encode()).hexdigest().encode()


def test_return_to_an_earlier_state_is_not_stored_again(spark, scratch):
    base = customer_snapshot(spark, SF_SMALL).filter(F.col("customer_id").isNotNull() & (F.col("c_custkey") % 23 != 0))
    k = F.col("c_custkey")
    states = ["A", "B", "A"]  # the city of keys divisible by 3 over three days
    paths = cust.LakePaths(*[f"{scratch}/{n}" for n in ("bronze", "hub", "general", "phone", "email", "dim")])
    for day, value in enumerate(states, start=1):
        snap = base.withColumn("city", F.when(k % 3 == 0, F.lit(value)).otherwise(F.col("city")))
        cust.load_snapshot(spark, snap, paths, LoadContext(f"2024-01-0{day} 06:00:00", "s"))
    dim = {r[cust.DIM_BK]: r for r in read_state(spark, cust.DIM_SPEC_TABLE, paths.dim)[0].collect()}
    hot = [r for key, r in dim.items() if key > 0 and key % 3 == 0]
    assert hot and all(r["CiudadUbicacion"] == "B" for r in hot)
    assert all(str(r[cust.LOAD]) == "2024-01-02 06:00:00" for r in hot)  # untouched on day 3
    hk = hashlib.sha256(str(hot[0][cust.DIM_BK]).encode()).hexdigest().encode()
    cities = sorted(r["CiudadUbicacion"] for r in read_table(spark, cust.GENERAL_SPEC, paths.general).filter(F.col(cust.HK) == F.lit(hk)).collect())
    assert cities == ["A", "B"]  # stored once each; the return to A is not stored again


def test_default_load_adds_nothing_to_tables_hashed_without_separator(spark, scratch):
    snap = customer_snapshot(spark, SF_SMALL)
    paths = cust.LakePaths(*[f"{scratch}/{n}" for n in ("bronze", "hub", "general", "phone", "email", "dim")])
    first = cust.load_snapshot(spark, snap, paths, LoadContext("2024-01-01 06:00:00", "s"), sep="")
    specs = ((cust.GENERAL_SPEC, paths.general), (cust.PHONE_SPEC, paths.phone), (cust.EMAIL_SPEC, paths.email))
    before = [read_table(spark, s, p).count() for s, p in specs]
    second = cust.load_snapshot(spark, snap, paths, LoadContext("2024-01-02 06:00:00", "s"))
    assert [read_table(spark, s, p).count() for s, p in specs] == before
    assert second == first  # and no dimension version
