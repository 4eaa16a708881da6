"""Small landed files written by the tests (FIXTURES.md): review CSVs per
platform, chart CSVs, API JSON responses and a review page."""

from __future__ import annotations

import json
import os

BOM = "﻿"

# (platform, file name, header, rows). Titles carry a space, brackets, a comma,
# an ampersand, a plus, a lone percent sign and an inner underscore.
REVIEW_FILES = [
    ("megabox", "Dune [IMAX], Part Two_20250319_megabox_reviews.csv",
     ["id", "context", "star", "review_date", "recommend_tags"],
     [
         ["m1", "정말 재밌어요 최고의 영화 연출 좋아요", "4.5", "2025.03.19", "['연출', '배우']"],
         ["m2", "두 줄\n리뷰 입니다 \"인용\" 포함 최고", "2.25", "2025.3.9", '["연출", "OST"]'],
         ["m3", "짧다", "5", "2025.03.19", "[]"],
         ["m4", "  앞뒤 공백이 있는 리뷰 텍스트  ", "5.1", "2025.03.19", ""],
         ["m5", "별점이 음수인 리뷰 텍스트입니다", "-1", "2025.03.19", "broken"],
         ["m1", "정말 재밌어요 최고의 영화 연출 좋아요", "4.0", "2025.03.18", "['연출']"],
     ]),
    ("megabox", "Tom & Jerry+_20250320_megabox_reviews.csv",
     ["id", "context", "star", "review_date", "recommend_tags"],
     [["t1", "ㅋㅋ 웃긴 장면이 많아서 좋았어요", "4.75", "2025.03.20", "['스토리']"]]),
    ("cgv", "100% Love_20250319_cgv_reviews.csv",
     ["id", "context", "date"],
     [["c1", "no hangul at all in this review", "2025-03-19"],
      ["c2", "날짜가 잘못된 리뷰 텍스트입니다", "2025.13.01"],
      ["c3", "", "2025.03.19"]]),
    ("cine", "My_Movie_20250319_cine_reviews.csv",
     ["who", "name", "context", "star", "date"],
     [["expert", "critic", "전문가 평론 리뷰 텍스트입니다", "3", ""],
      ["netizen", "n1", "일반 관객 리뷰 텍스트　입니다", "0", "2025.03.19"]]),
    ("watcha", "Undated Film_watcha_reviews.csv",
     ["id", "star", "context"],
     [["w1", "None", "왓챠 리뷰는 날짜가 없습니다 ㅠㅠ"],
      ["w2", "3.5", "왓챠 두번째 리뷰 텍스트입니다"]]),
]


def _csv_field(v: str) -> str:
    if any(ch in v for ch in ',"\n'):
        return '"' + v.replace('"', '""') + '"'
    return v


def write_csv(path: str, header, rows, bom: bool = True) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    lines = [",".join(header)] + [",".join(_csv_field(x) for x in r) for r in rows]
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write((BOM if bom else "") + "\n".join(lines) + "\n")


def write_reviews(root: str) -> dict[str, str]:
    folders = {}
    for platform, name, header, rows in REVIEW_FILES:
        folder = os.path.join(root, f"{platform}_reviews")
        folders[platform] = folder
        write_csv(os.path.join(folder, name), header, rows)
    return folders


BOX_HEADER = ["rank", "rankInten", "rankOldAndNew", "movieCd", "movieNm", "openDt", "salesAmt", "salesShare",
              "salesInten", "salesChange", "salesAcc", "audiCnt", "audiInten", "audiChange", "audiAcc",
              "scrnCnt", "showCnt"]


def box_entry(rank: int, name: str, sales: str = "1000", acc: str = "3000000000") -> dict:
    return {"rank": str(rank), "rankInten": "0", "rankOldAndNew": "OLD", "movieCd": f"{rank:08d}",
            "movieNm": name, "openDt": "2025-02-26", "salesAmt": sales, "salesShare": "12.5",
            "salesInten": "-100", "salesChange": "-9.1", "salesAcc": acc, "audiCnt": "100",
            "audiInten": "-5", "audiChange": "-4.8", "audiAcc": "2500000", "scrnCnt": "900", "showCnt": "3000"}


def write_box_csv(root: str) -> str:
    folder = os.path.join(root, "daily_boxoffice")
    rows = [[box_entry(1, "Dune")[k] for k in BOX_HEADER],
            [box_entry(2, "Tom & Jerry", sales="x")[k] for k in BOX_HEADER]]
    write_csv(os.path.join(folder, "daily_box_office_20250319.csv"), BOX_HEADER, rows)
    rows2 = [[box_entry(1, "Dune", sales="2000")[k] for k in BOX_HEADER]]
    write_csv(os.path.join(folder, "daily_box_office_20250320.csv"), BOX_HEADER, rows2)
    return folder


def write_box_json(root: str) -> tuple[str, str, str]:
    daily = os.path.join(root, "api_daily")
    os.makedirs(daily, exist_ok=True)
    payload = {"boxOfficeResult": {"boxofficeType": "일별 박스오피스", "showRange": "20250319~20250319",
                                   "dailyBoxOfficeList": [box_entry(1, "Dune"), box_entry(2, "Wicked")]}}
    with open(os.path.join(daily, "d.json"), "w", encoding="utf-8") as f:
        json.dump(payload, f, ensure_ascii=False)
    bad = os.path.join(root, "api_bad")
    os.makedirs(bad, exist_ok=True)
    with open(os.path.join(bad, "d.json"), "w", encoding="utf-8") as f:
        json.dump({"faultInfo": {"message": "invalid key"}}, f)
    region = os.path.join(root, "api_region")
    os.makedirs(region, exist_ok=True)
    docs = [
        {"region_code": "0105001000", "region_name": "서울시", "data": payload},
        {"region_code": "0105002000", "region_name": "경기도",
         "data": {"boxOfficeResult": {"showRange": "20250319~20250319",
                                      "dailyBoxOfficeList": [box_entry(1, "Dune")]}}},
        {"region_code": "0105003000", "region_name": "강원도", "data": {"boxOfficeResult": {"dailyBoxOfficeList": []}}},
        {"region_code": "0105004000", "region_name": "충청북도", "data": {}},
    ]
    for i, d in enumerate(docs):
        with open(os.path.join(region, f"r{i}.json"), "w", encoding="utf-8") as f:
            json.dump(d, f, ensure_ascii=False)
    return daily, bad, region


def write_region_codes(root: str) -> str:
    folder = os.path.join(root, "codes")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "codes.json"), "w", encoding="utf-8") as f:
        json.dump({"codes": [{"fullCd": "0105001000", "korNm": "서울시", "engNm": "Seoul"},
                             {"fullCd": "0105002000", "korNm": "경기도", "engNm": "Gyeonggi"}]}, f,
                  ensure_ascii=False)
    return folder
