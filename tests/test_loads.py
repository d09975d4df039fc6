"""Loads publish each table; the fact reads the published tables."""

import uuid

from conftest import SMALL_SF

from dimforge.operators import origin_registry
from dimforge.plans import load_field, load_site
from dimforge.plans.loads import FIELD_TABLE, SITE_TABLE, published
from dimforge.sources.driver_tables import DriverTables
from dimforge.sources.snapshot import snapshot_path


def test_load_site_variants_and_field(spark):
    t = DriverTables(spark, SMALL_SF)
    owner = f"dimforge_t_{uuid.uuid4().hex[:8]}"
    base = snapshot_path(spark, "tests", uuid.uuid4().hex)
    reg = origin_registry(spark)
    assert load_site(t.site_raw(), reg, owner, base)
    assert len(published(spark, owner, SITE_TABLE).columns) == 12
    assert load_site(t.site_raw(), reg, owner, base, analysis=True)
    assert published(spark, owner, SITE_TABLE).columns[-1] == "ID_FAZENDA_PROD"
    assert load_field(t.field_raw(), reg, owner, base)
    field = published(spark, owner, FIELD_TABLE)
    assert field.count() > 0 and set(r[0] for r in field.select("ID_ORIGEM_DB").distinct().collect()) == {1000, 2000}


def test_fact_is_not_built_on_an_older_dimension(spark, monkeypatch):
    from dimforge.plans import loads

    built = []
    monkeypatch.setattr(loads, "load_field", lambda *a, **k: False)
    monkeypatch.setattr(loads, "load_site", lambda *a, **k: True)
    monkeypatch.setattr(loads, "load_variety", lambda *a, **k: True)
    monkeypatch.setattr(loads, "load_planning", lambda *a, **k: built.append(1) or True)
    done = loads.load_all({}, origin_registry(spark), "dimforge_none")
    assert done == {FIELD_TABLE: False, SITE_TABLE: True, loads.VARIETY_TABLE: True, loads.PLANNING_TABLE: False}
    assert not built
