"""The file-to-file jobs on small hand-made inputs."""

import glob
import json
import os

from cobble import jobs
from cobble.session import shared_scratch


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _lines(folder):
    out = []
    for p in sorted(glob.glob(os.path.join(folder, "part-*"))):
        out += open(p).read().splitlines()
    return out


def _violation_row(summons, date, county, house, street):
    f = [""] * 26
    f[0], f[4], f[21], f[23], f[24] = summons, date, county, house, street
    return ",".join(f)


def test_violations_job(spark):
    base = shared_scratch(spark, "job_viol")
    header = ",".join(["Summons Number"] + [f"h{i}" for i in range(1, 26)])
    rows = [
        _violation_row("1", "01/02/2015", "NY", "41", "w  8th st"),      # label W8ST, odd -> left range of seg 10
        _violation_row("2", "03/04/2019", "MN", "41", "W 8 ST"),
        _violation_row("3", "03/04/2019", "MN", "40", "W 8 ST"),        # even -> right range of seg 11
        _violation_row("4", "03/04/2014", "MN", "40", "W 8 ST"),        # year out of range
        _violation_row("5", "03/04/2016", "XX", "40", "W 8 ST"),        # borough not accepted
        _violation_row("6", "03/04/2017", "K", "12-5", "BIG ROAD"),     # alias BIGROAD -> label MAINST in Brooklyn
    ]
    _write(f"{base}/v/2015.csv", header + "\n" + "\n".join(rows[:3]) + "\n")
    _write(f"{base}/v/2016.csv", header + "\n" + "\n".join(rows[3:]) + "\n")
    feats = [
        {"physicalid": "10", "st_label": "W 8 ST", "full_stree": "WEST 8 STREET", "borocode": "1",
         "l_low_hn": "1", "l_high_hn": "99", "r_low_hn": "100", "r_high_hn": "198"},
        {"physicalid": "11", "st_label": "W 8 ST", "full_stree": "WEST 8 STREET", "borocode": "1",
         "l_low_hn": "101", "l_high_hn": "199", "r_low_hn": "2", "r_high_hn": "98"},
        {"physicalid": "12", "st_label": "MAIN ST", "full_stree": "BIG ROAD", "borocode": "3",
         "l_low_hn": "10-1", "l_high_hn": "14-9", "r_low_hn": "10-2", "r_high_hn": "14-8"},
    ]
    _write(f"{base}/seg.json", json.dumps({"type": "FeatureCollection",
                                            "features": [{"type": "Feature", "properties": p, "geometry": None} for p in feats]}))
    _write(f"{base}/ids.txt", "9,10,11,12,12")
    jobs.violations(spark, f"{base}/v/*.csv", f"{base}/seg.json", f"{base}/ids.txt", f"{base}/out")
    assert _lines(f"{base}/out") == [
        "9, 0, 0, 0, 0, 0, 0",
        "10, 1, 0, 0, 0, 1, 0.0",
        "11, 0, 0, 0, 0, 1, 0.2",
        # exponents as Python prints them
        "12, 0, 0, 1, 0, 0, 5.551115123125783e-18",
        "12, 0, 0, 1, 0, 0, 5.551115123125783e-18",
    ]


def test_complaints_job(spark):
    base = shared_scratch(spark, "job_cmp")
    text = (
        "Date received,Product,Sub-product,Issue,Sub-issue,Consumer complaint narrative,Company public response,"
        "Company,State,ZIP code,Tags,Consumer consent provided?,Submitted via,Date sent to company\n"
        '2019-01-01,"Debt collection",x,y,z,"line one\nline two",r,Acme,NY,1,t,c,Web,2019-01-02\n'
        "2019-01-01,Debt collection,x,y,z,n,r,Acme,NY,1,t,c,Web,2019-02-02\n"
        '2019-01-01,"Loan, or lease",x,y,z,n,r,Bolt,NY,1,t,c,Web,2020-01-02\n'
        "2019-01-01,Debt collection,x,y,z,n,r,Corp,NY,1,t,c,Web,2019-03-02\n"
    )
    _write(f"{base}/c.csv", text)
    jobs.complaints(spark, f"{base}/c.csv", f"{base}/out")
    assert sorted(_lines(f"{base}/out")) == sorted(["Debt collection,2019,3,2,67", '"Loan, or lease",2020,1,1,100'])


def test_revenue_job(spark):
    base = shared_scratch(spark, "job_rev")
    _write(f"{base}/sale.csv", "Customer ID,Transaction ID,Date,Product ID,Item Cost\n"
           "c1,t1,d,p9,1.10\nc1,t2,d,p9,2.20\nc2,t3,d,p9,0.70\nc1,t4,d,p2,5.00\n")
    jobs.revenue(spark, f"{base}/sale.csv", f"{base}/out")
    lines = [l for l in _lines(f"{base}/out") if not l.startswith("Product ID")]
    assert _lines(f"{base}/out")[0] == "Product ID, Customer Count, Total Revenue"
    assert lines == ["p9,2,4.00", "p2,1,5.00"]  # first-appearance order


def test_bikes_job(spark):
    base = shared_scratch(spark, "job_bike")
    trips = ("tripduration,starttime,stoptime,start station id,start station name,a,b,end station id,"
             "end station name,c,d,bikeid,usertype,birth year,gender\n")
    rows = [
        ("2015-02-01 00:00:00", "2015-02-01 00:30:00", "A", "B", "Subscriber", 1),
        ("2015-02-01 00:10:00", "2015-02-01 00:20:00", "B", "A", "Subscriber", 1),
        ("2015-02-01 00:20:00", "2015-02-01 00:40:00", "A", "A", "Customer", 2),
        ("2015-02-02 08:00:00", "2015-02-02 08:05:00", "C", "A", "Subscriber", 2),
    ]
    trips += "".join(f"1,{s},{e},1,{a},0,0,2,{b},0,0,9,{u},1980,{g}\n" for s, e, a, b, u, g in rows)
    _write(f"{base}/trips.csv", trips)
    _write(f"{base}/dock.csv", "time,bikeid,station_id,event\n"
           "2015-02-01 00:00:00,1,1,undock\n2015-02-01 00:01:00,2,1,undock\n2015-02-01 00:02:00,1,2,dock\n"
           "2015-02-01 00:03:00,3,1,undock\n2015-02-01 00:04:00,3,1,other\n")
    res = jobs.bikes(spark, f"{base}/trips.csv", f"{base}/dock.csv", f"{base}/out")
    assert res["max_riders_from_docks"].first()[0] == 2
    # [00:00,00:30) [00:10,00:20) [00:20,00:40): the 00:20 stop comes before the 00:20 start
    assert res["max_riders_from_trips"].first()[0] == 2
    assert {r["station"]: r["trips"] for r in res["station_trips"].collect()} == {"A": 5, "B": 2, "C": 1}
    top = {r["gender"]: (r["start_station_name"], r["trips"]) for r in res["top_station_by_gender"].collect()}
    assert top == {"Male": ("A", 1), "Female": ("C", 1)}
    firsts = {str(r["day"]): r["start_station_name"] for r in res["first_ride_of_day"].collect()}
    assert firsts == {"2015-02-01": "A", "2015-02-02": "C"}


def test_schools_job(spark):
    base = shared_scratch(spark, "job_sch")
    _write(f"{base}/sat.csv", "DBN,SCHOOL NAME,Num of SAT Test Takers,Reading,Math,Writing\n"
           "01A,a,10,1,400,1\n02B,b,5,1,500,1\n03C,c,s,s,s,s\n")
    cols = 58
    def school(dbn, boro, students):
        f = [""] * cols
        f[0], f[2], f[17], f[57] = dbn, boro, students, "x"
        return ",".join(f)
    header = ",".join(["dbn"] + [f"h{i}" for i in range(1, cols)])
    _write(f"{base}/dir.csv", header + "\n" + "\n".join([school("01A", "M", "900"), school("02B", "M", "600"),
                                                         school("03C", "M", "700"), school("04D", "Q", "100"),
                                                         # one field too many, one too few: no rows
                                                         school("01A", "Z", "900") + ",y", school("01A", "Z", "900")[:-2]]) + "\n")
    rep = {r["boro"]: r["mean_score"] for r in jobs.schools(spark, f"{base}/sat.csv", f"{base}/dir.csv", f"{base}/out").collect()}
    assert rep == {"M": 433}


def test_words_and_keywords_jobs(spark):
    base = shared_scratch(spark, "job_txt")
    _write(f"{base}/t/a.txt", "He saw House of the cat. ABC of\nthe the The it's\n")
    counts = {r["word"]: r["n"] for r in jobs.words(spark, f"{base}/t/*.txt", f"{base}/w").collect()}
    assert counts["the"] == 4 and counts["it's"] == 1
    kw = [r["keyword"] for r in jobs.keywords(spark, f"{base}/t/*.txt", f"{base}/k").orderBy("sentence", "pos").collect()]
    # sentences end only at ".": the phrase runs on across the newline
    assert kw == ["House of the", "ABC of the the The"]


def test_words_job_first_lines(spark):
    base = shared_scratch(spark, "job_first")
    _write(f"{base}/t/a.txt", "".join(f"alpha line{i}\n" for i in range(200)))
    # a second, larger file sorts after a.txt by path even though Spark packs larger splits first
    _write(f"{base}/t/b.txt", "".join(f"alpha x{i}\n" for i in range(100)) + "".join("omega\n" for _ in range(5000)))
    counts = {r["word"]: r["n"] for r in jobs.words(spark, f"{base}/t/*.txt", f"{base}/w", first_lines=300).collect()}
    assert counts["alpha"] == 300 and "omega" not in counts
    most = _lines(f"{base}/w/most_used")
    assert most == ["300,alpha"]


def test_violations_job_feature_lines_keep_file_order(spark):
    base = shared_scratch(spark, "job_lines")
    header = ",".join(["Summons Number"] + [f"h{i}" for i in range(1, 26)])
    _write(f"{base}/v/a.csv", header + "\n" + _violation_row("1", "01/02/2016", "NY", "41", "MAIN ST") + "\n")

    def feat(pid):
        return json.dumps({"type": "Feature", "geometry": None, "properties": {
            "physicalid": str(pid), "st_label": "MAIN ST", "full_stree": "MAIN ST", "borocode": "1",
            "l_low_hn": "1", "l_high_hn": "99", "r_low_hn": "2", "r_high_hn": "98"}})

    # a.json holds the first matching segment; b.json is larger, so Spark reads it first
    _write(f"{base}/seg/a.json", feat(100) + "\n")
    _write(f"{base}/seg/b.json", "\n".join(feat(200 + i) for i in range(2000)) + "\n")
    _write(f"{base}/ids.txt", "100")
    jobs.violations(spark, f"{base}/v/*.csv", f"{base}/seg/*.json", f"{base}/ids.txt", f"{base}/out", collection=False)
    assert _lines(f"{base}/out")[0] == "100, 0, 1, 0, 0, 0, -0.1"
