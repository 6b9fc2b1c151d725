from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from amity.session import build_session  # noqa: E402

FRIEND_LINES = [
    "0\t1,2,3",
    "1\t0,2,3",
    "2\t0,1",
    "3\t0,1",
    "4\t",                 # no friends: skipped, not a reject
    "6\t7",
    "7\t6",
    "8\t0",                # one-sided, nothing shared
    "9\t0,1",              # one-sided, something shared
    "10\t11,11",           # repeated id
    "11\t10",
    "12\t13",              # two lines for one user
    "12\t14",
    "13\t12,14",
    "14\t12,13",
    "15\t15",              # self friend
    "16\tx",               # bad id
    "17\t18,,",            # trailing empties
    "18\t17",
    "19\t20,,21",          # inner empty: a reject, 20 and 21 stay
    "20\t19",
    "21\t19",
    "022\t23",             # leading zero
    "23\t22",
    "24\t25\textra",       # three fields
    "26\t27\t",            # trailing tab
    "27\t26",
    "28\t29,2",
    "29\t28,3",
    "",
]

PROFILE_LINES = [
    "0,Ann,Ash,1 A St,Akron,Ohio,x,x,x,1/1/1990",
    "1,Bob,Birch,2 B St,Boise,Idaho,x,x,x,6/15/1980",
    "2,Cy,Cedar,3 C St,Cary,North Carolina,x,x,x,12/31/1990",
    "3,Cy,Cedar,4 D St,Dover,Delaware,x,x,x,12/31/1990",
    "6,Di,Dell,6 F St,Flint,Michigan,x,x,x,bad",
    "7,Ed,Elm,7 G St,Gary,Indiana,x,x,x,6/16/1950",
    '10,"Fay,Fir,10 J St,Jena,Ohio,x,x,x,2/29/1960',
]

BUSINESS_LINES = [
    "b1::12 Main St Stanford, CA::List(Food, Bars)",
    "b2::1 First St: Stanford, CA::List(Parks)",
    "b3::9 Elm St stanford, CA::List(X)",
    "b4::5 Oak St Reno, NV::List(Y)",
    "b1::12 Main St Stanford, CA::List(Food, Bars)",
]

REVIEW_LINES = [
    "r1::u1::b1::5.0",
    "r2::u1::b1::5.0",
    "r3::u2::b1::4",
    "r4::u2::b2::4.0",
    "r5::u3::b2::bad",
    "r6::u4::b3::3.0",
    "r7::u5::b9::1.0",
]


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="amity-tests", shuffle_partitions=8)
    yield s
    s.stop()


def write_lines(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


@pytest.fixture
def friends_path(tmp_path):
    return write_lines(tmp_path, "friends.txt", FRIEND_LINES)


@pytest.fixture
def profiles_path(tmp_path):
    return write_lines(tmp_path, "userdata.txt", PROFILE_LINES)


@pytest.fixture
def business_path(tmp_path):
    return write_lines(tmp_path, "business.csv", BUSINESS_LINES)


@pytest.fixture
def reviews_path(tmp_path):
    return write_lines(tmp_path, "review.csv", REVIEW_LINES)
