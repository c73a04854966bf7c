import csv
import io

import pytest
from small_fact import SMALL

from scopewise.session import local_session
from scopewise.spec import DEFAULT_SPEC


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 8, **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def fact(spark):
    """Build a typed fact from (scope, scope id, name, code, micro, small, medium)."""

    def build(rows, totals=None):
        data = []
        for i, (scope, scope_id, name, code, micro, small, medium) in enumerate(rows):
            total = totals[i] if totals else micro + small + medium
            data.append((scope, scope_id, name, code, medium, micro, small, total))
        return spark.createDataFrame(data, DEFAULT_SPEC.fact_schema())

    return build


@pytest.fixture
def raw(spark):
    """Build an all-text fact from rows in the order of the required columns."""

    def build(rows):
        return spark.createDataFrame(rows, DEFAULT_SPEC.raw_schema())

    return build


@pytest.fixture
def small(fact):
    return fact(SMALL)


# The published table of one scope, 33 entities with all 17 columns.
PUBLISHED = """\
state_name,state_id,district_name,lg_dt_code,medium,micro,small,total,district_rank_total,district_rank_total_ascending,micro_share_pct,small_share_pct,medium_share_pct,gujarat_total_share_pct,dominant_category,top_10_flag,bottom_10_flag
GUJARAT,24,AHMADABAD,438,1221,589495,13045,603761,1,33,97.6371,2.1606,0.2022,19.9375,MICRO,True,False
GUJARAT,24,SURAT,459,719,576838,11299,588856,2,32,97.9591,1.9188,0.1221,19.4453,MICRO,True,False
GUJARAT,24,RAJKOT,457,465,275078,5119,280662,3,31,98.0104,1.8239,0.1657,9.2681,MICRO,True,False
GUJARAT,24,VADODARA,461,279,219538,3211,223028,4,30,98.4352,1.4397,0.1251,7.3649,MICRO,True,False
GUJARAT,24,KACHCHH,449,199,111827,2535,114561,5,29,97.6135,2.2128,0.1737,3.7831,MICRO,True,False
GUJARAT,24,VALSAD,462,141,86624,1619,88384,6,28,98.0087,1.8318,0.1595,2.9186,MICRO,True,False
GUJARAT,24,BHAVNAGAR,443,92,86210,1334,87636,7,27,98.3728,1.5222,0.105,2.8939,MICRO,True,False
GUJARAT,24,BANAS KANTHA,441,59,79196,1073,80328,8,26,98.5908,1.3358,0.0734,2.6526,MICRO,True,False
GUJARAT,24,JAMNAGAR,447,98,74079,1433,75610,9,25,97.9751,1.8953,0.1296,2.4968,MICRO,True,False
GUJARAT,24,ANAND,440,36,74597,704,75337,10,24,99.0177,0.9345,0.0478,2.4878,MICRO,True,False
GUJARAT,24,GANDHINAGAR,446,101,68708,1220,70029,11,23,98.1136,1.7421,0.1442,2.3125,MICRO,False,False
GUJARAT,24,BHARUCH,442,82,68270,1372,69724,12,22,97.9146,1.9678,0.1176,2.3024,MICRO,False,False
GUJARAT,24,MAHESANA,451,203,66827,1982,69012,13,21,96.8339,2.872,0.2942,2.2789,MICRO,False,False
GUJARAT,24,MORBI,673,237,55481,2458,58176,14,20,95.3675,4.2251,0.4074,1.9211,MICRO,False,False
GUJARAT,24,KHEDA,450,26,55638,456,56120,15,19,99.1411,0.8125,0.0463,1.8532,MICRO,False,False
GUJARAT,24,JUNAGADH,448,34,55102,796,55932,16,18,98.5161,1.4232,0.0608,1.847,MICRO,False,False
GUJARAT,24,SURENDRANAGAR,460,34,45990,552,46576,17,17,98.7418,1.1852,0.073,1.538,MICRO,False,False
GUJARAT,24,NAVSARI,453,24,43502,462,43988,18,16,98.8952,1.0503,0.0546,1.4526,MICRO,False,False
GUJARAT,24,SABAR KANTHA,458,37,41447,592,42076,19,15,98.5051,1.407,0.0879,1.3894,MICRO,False,False
GUJARAT,24,PANCH MAHALS,454,26,36102,325,36453,20,14,99.0371,0.8916,0.0713,1.2038,MICRO,False,False
GUJARAT,24,DOHAD,445,11,35827,259,36097,21,13,99.252,0.7175,0.0305,1.192,MICRO,False,False
GUJARAT,24,AMRELI,439,34,33674,456,34164,22,12,98.5657,1.3347,0.0995,1.1282,MICRO,False,False
GUJARAT,24,PATAN,455,26,31209,403,31638,23,11,98.644,1.2738,0.0822,1.0448,MICRO,False,False
GUJARAT,24,GIR SOMNATH,675,6,30935,348,31289,24,10,98.8686,1.1122,0.0192,1.0332,MICRO,False,True
GUJARAT,24,ARVALLI,672,3,21974,206,22183,25,9,99.0578,0.9286,0.0135,0.7325,MICRO,False,True
GUJARAT,24,PORBANDAR,456,12,20152,247,20411,26,8,98.7311,1.2101,0.0588,0.674,MICRO,False,True
GUJARAT,24,DEVBHOOMI DWARKA,674,8,17696,184,17888,27,7,98.9267,1.0286,0.0447,0.5907,MICRO,False,True
GUJARAT,24,BOTAD,676,16,17171,294,17481,28,6,98.2266,1.6818,0.0915,0.5773,MICRO,False,True
GUJARAT,24,MAHISAGAR,669,1,13984,55,14040,29,5,99.6011,0.3917,0.0071,0.4636,MICRO,False,True
GUJARAT,24,TAPI,641,10,13560,145,13715,30,4,98.8699,1.0572,0.0729,0.4529,MICRO,False,True
GUJARAT,24,CHHOTAUDEPUR,668,4,12021,87,12112,31,3,99.2487,0.7183,0.033,0.4,MICRO,False,True
GUJARAT,24,NARMADA,452,1,8543,52,8596,32,2,99.3834,0.6049,0.0116,0.2839,MICRO,False,True
GUJARAT,24,DANG,444,0,2392,12,2404,33,1,99.5008,0.4992,0.0,0.0794,MICRO,False,True
"""


@pytest.fixture
def published_rows():
    return list(csv.DictReader(io.StringIO(PUBLISHED)))


@pytest.fixture
def published(fact, published_rows):
    names = ("state_name", "state_id", "district_name", "lg_dt_code", "micro", "small", "medium")
    rows = [tuple(row[n] for n in names[:4]) + tuple(int(row[n]) for n in names[4:]) for row in published_rows]
    return fact(rows, [int(row["total"]) for row in published_rows])
