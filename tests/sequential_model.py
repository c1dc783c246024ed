"""A brute-force, one-dataset-at-a-time model of the import rules.

Test code only: it walks datasets in numeric id order and timeseries in id
order, like the reference does, on tiny Python inputs.  The Spark plan must
give the same outcomes, owners, counters and errors.
"""

from __future__ import annotations

import json
import re

HIDDEN = "nothing"


def site_id(raw):
    if raw is None:
        return None
    m = re.match(r"^([0-9]+)(_|$)", raw.strip())
    return int(m.group(1)) if m else None


def simulate(projects, timeseries, images, labels, prior_ts, prior_ds, ids, single=False, repeated=()):
    """projects: list of dicts (id, status, camera_id, timeseries);
    timeseries: dicts (id, images, predicted_label, ground_truth_label, status, bad_date);
    images: dict id -> dict (exif, boxes: list of (label, coords) or None);
    labels: dict text -> blur; prior_ts: dict ts_id -> ds_key; prior_ds: set of keys;
    repeated: keys that prior state holds twice, so that looking them up fails."""
    state_ts = dict(prior_ts)
    state_ds = set(prior_ds)
    outcome, owner = {}, {}
    for ds in sorted(ids, key=int):
        rows = [p for p in projects if p["id"] == ds]
        if not rows:
            outcome[ds] = ("not_found", 0, 0, 0)
            continue
        row = rows[0]
        if row["status"] == "failed":
            outcome[ds] = ("failed_status", 0, 0, 0)
            continue
        if site_id(row["camera_id"]) is None:
            outcome[ds] = ("bad_site", 0, 0, 0)
            continue
        key = int(ds)
        old = {t for t, k in state_ts.items() if k == key} if key in state_ds else set()
        listed = set()
        for r in rows:
            listed |= set(x for x in (r["timeseries"] or []) if x is not None)
        tset = sorted((t for t in timeseries if t["id"] in listed and t["id"] not in old), key=lambda t: t["id"])
        if not tset:
            outcome[ds] = ("no_new_timeseries", 0, 0, 0)
            continue
        state_ds.add(key)
        errors = n_images = 0
        aborted = False
        for t in tset:
            for lab in (t["predicted_label"], t["ground_truth_label"]):
                if lab and lab not in labels:
                    aborted = True
            if t["bad_date"] or t["id"] in repeated:
                aborted = True
            if aborted:
                break
            if t["id"] in state_ts:
                continue
            if t["status"] == "verified" and not t["ground_truth_label"]:
                aborted = True
                break
            refs = [i for tt in timeseries if tt["id"] == t["id"] for i in (tt["images"] or [])]
            imgs = [images[i] for i in refs if i in images]
            bad = False
            for img in imgs:
                try:
                    json.loads(img["exif"])
                except Exception:
                    bad = True
                if img["boxes"] is None:
                    bad = True
                    continue
                for label, coords in img["boxes"]:
                    if label not in labels:
                        bad = True
                    elif labels[label] and any(c is None for c in coords):
                        bad = True
            if bad:
                errors += 1
            else:
                state_ts[t["id"]] = key
                owner[t["id"]] = ds
                n_images += len(imgs)
            if single:
                break
        outcome[ds] = ("aborted" if aborted else "imported", len(tset), n_images, errors)
    return outcome, owner
