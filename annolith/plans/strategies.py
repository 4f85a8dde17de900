"""Look-alikes: values that resemble a label and are none, with the cues that their sentence needs and may not have."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from annolith.functions import templates
from annolith.plans.values import LISTS

SCHEMA = (
    "strategy_id string, label string, family string, semantic_type string, template string, value_regex string, required array<string>, "
    f"forbidden array<string>, negative_labels array<string>, collision_labels array<string>, parts array<{templates.PART}>"
)
#: family -> (cues of which one must stand in the sentence, cues that must not lead to the value)
FAMILIES = {
    "schema_field": (["cột trong bảng dữ liệu", "biến của chương trình"], ["của anh", "của chị"]),
    "catalog_code": (["ký hiệu trong danh mục", "số hiệu tra cứu"], ["của anh", "của chị"]),
    "invalid_value": (["giá trị nhập sai", "mẫu thử bị loại"], ["hẹn gặp", "gọi cho"]),
    "product_name": (["tên mặt hàng", "nhãn hàng"], ["của anh", "của chị"]),
    "quantity": (["chỉ số đo", "kết quả đếm"], ["hẹn gặp", "gọi cho"]),
}
#: label -> (family, what it is, template): one look-alike of its own for each label.
OWN = {
    "PREFIX": ("product_name", "tea_brand", "trà Ông Bụt số {2d}"),
    "PERSON": ("product_name", "rice_brand", "gạo Lan Hương loại {letter}{2d}"),
    "GENDER": ("schema_field", "enum_member", "gt_kieu_{letter}{2d}"),
    "AGE": ("quantity", "storage_time", "rượu ủ {2d} mùa {letter}"),
    "BIRTHDATE": ("invalid_value", "impossible_date", "31/02/19{2d}"),
    "PHONE": ("catalog_code", "spare_part", "ốc {3d}-{2d}-{letter}"),
    "EMAIL": ("invalid_value", "address_without_domain", "hopthu{4d}@"),
    "LOCATION": ("product_name", "coffee_line", "cà phê Cao Nguyên {letter}{2d}"),
    "ADDRESS": ("schema_field", "layout_cell", "ô {2d} hàng {letter}"),
    "ZIP_CODE": ("catalog_code", "colour_code", "màu {letter}{4d}"),
    "COORDINATE": ("quantity", "screen_position", "điểm ảnh {3d}x{2d}"),
    "USERNAME": ("schema_field", "service_role", "vai_tro_{letter}{3d}"),
    "ACCOUNT_ID": ("catalog_code", "ledger_row", "dòng sổ {letter}{3d}"),
    "TICKET_ID": ("catalog_code", "queue_place", "quầy {letter} lượt {2d}"),
    "PASSWORD": ("schema_field", "rule_name", "luat_do_dai_{letter}{2d}"),
    "PIN": ("quantity", "pressure", "{3d} bar mức {letter}"),
    "API_KEY": ("schema_field", "variable_name", "KHOA_CAU_HINH_{letter}{2d}"),
    "URL": ("invalid_value", "path_without_host", "//thu-muc/{letter}{3d}"),
    "IP": ("catalog_code", "software_version", "bản {1-9}.{0-9}.{0-9} nhánh {letter}"),
    "BANK_ACCOUNT": ("catalog_code", "shelf_number", "kệ {letter}{4d}"),
    "MONEY": ("quantity", "points", "{3d} điểm hạng {letter}"),
    "CARD_ISSUER": ("product_name", "travel_paper", "thị thực loại {letter}{2d}"),
    "CARD_NUMBER": ("product_name", "game_card", "thẻ bài {letter}{3d}"),
    "CVV": ("quantity", "page_count", "{3d} trang khổ {letter}"),
    "IBAN": ("catalog_code", "book_mark", "sách FR/{letter}{3d}"),
    "SWIFT": ("product_name", "car_line", "xe Swift đời {letter}{2d}"),
    "WALLET": ("product_name", "leather_goods", "ví da mẫu {letter}{2d}"),
    "JOB_TITLE": ("product_name", "board_game", "trò Thợ Săn bản {letter}{2d}"),
    "ORGANIZATION": ("product_name", "project_name", "dự án Bầu Trời {letter}{2d}"),
    "EMPLOYEE_ID": ("catalog_code", "desk_number", "bàn {letter}{2d} tầng {1-9}"),
    "NATIONAL_ID": ("catalog_code", "parcel_mark", "kiện {letter}{5d}"),
    "PASSPORT": ("product_name", "notebook", "sổ tay Hộ Chiếu {letter}{2d}"),
    "LICENSE": ("product_name", "software_edition", "bản quyền mẫu {letter}{3d}"),
    "PLATE": ("product_name", "dish_model", "đĩa sứ {letter}{3d}"),
    "TIN": ("product_name", "tin_can", "hộp thiếc {letter}{3d}"),
    "DATE": ("invalid_value", "impossible_date", "45/{13-99}/20{2d}"),
    "TIME": ("invalid_value", "impossible_time", "27:{60-99}"),
    "MARITAL": ("schema_field", "status_flag", "co_don_le_{letter}{2d}"),
    "RELIGION": ("product_name", "song_title", "bài hát Chuông Chiều {letter}{2d}"),
    "ETHNICITY": ("product_name", "fabric", "vải thổ cẩm mẫu {letter}{2d}"),
    "TRADE_UNION": ("schema_field", "set_operation", "phep_hop_{letter}{2d}"),
    "NATIONALITY": ("product_name", "dish_name", "món Pháp số {letter}{2d}"),
    "INSURANCE_ID": ("catalog_code", "warranty_mark", "bảo hành {letter}/{3d}"),
    "MEDICAL_INFO": ("invalid_value", "device_fault", "lỗi tim máy {letter}{2d}"),
}
#: Two more look-alikes of their own for labels whose values have several formats.
MORE_OWN = {
    "PERSON": [("catalog_code", "street_sign", "biển đường Lê Lai đoạn {letter}{2d}"), ("quantity", "statue_height", "tượng Hai Bà cao {2d} tấc mẫu {letter}")],
    "PHONE": [("quantity", "meter_reading", "công tơ {5d} kWh ô {letter}"), ("schema_field", "extension_key", "may_le_{letter}{3d}")],
    "EMAIL": [("schema_field", "letter_template", "mau_thu_{letter}{2d}"), ("product_name", "envelope", "phong bì A Còng {letter}{2d}")],
    "ADDRESS": [("catalog_code", "warehouse_slot", "kho {letter} dãy {2d} ngăn {1-9}"), ("product_name", "board_square", "ô cờ Phố Cổ {letter}{2d}")],
    "LOCATION": [("schema_field", "region_key", "vung_mien_{letter}{2d}"), ("catalog_code", "map_sheet", "mảnh bản đồ {letter}{2d} tờ {1-9}")],
    "DATE": [("quantity", "scale_ratio", "tỉ lệ {1-9}/{20-90} khổ {letter}"), ("catalog_code", "lot_mark", "lô sản xuất {letter}{2d}/{3d}")],
    "TIME": [("quantity", "match_score", "tỉ số {1-9}:{60-99} hiệp {letter}"), ("schema_field", "duration_key", "thoi_luong_{letter}{2d}")],
    "MONEY": [("catalog_code", "coin_model", "xu kỷ niệm {letter}{3d}"), ("product_name", "game_token", "thẻ nạp Vàng {letter}{2d}")],
    "URL": [("schema_field", "route_key", "duong_dan_{letter}{2d}"), ("product_name", "site_theme", "giao diện Mạng Nhện {letter}{2d}")],
    "IP": [("quantity", "section_number", "mục {1-9}.{0-9} khoản {letter}{2d}"), ("product_name", "housing_class", "vỏ chống nước IP{60-69} loại {letter}")],
    "CARD_NUMBER": [("catalog_code", "library_slip", "phiếu mượn {letter}{4d}"), ("quantity", "step_count", "{4d} bước chân chặng {letter}")],
    "PLATE": [("catalog_code", "engraving", "bản khắc {letter}{3d}"), ("quantity", "weight_plate", "tạ đĩa {2d} cân số {letter}")],
    "PASSPORT": [("catalog_code", "stamp_design", "mẫu tem {letter}{4d}"), ("schema_field", "travel_flag", "co_xuat_canh_{letter}{2d}")],
    "MEDICAL_INFO": [("product_name", "herbal_tea", "trà Thanh Nhiệt {letter}{2d}"), ("quantity", "device_level", "mức đo thiết bị {2d}{letter}")],
}
#: Two more for every other label, by a rule; `{slug}` is the label in lower case.
MORE = [("schema_field", "column_name", "cot_{slug}_{letter}{2d}"), ("invalid_value", "rejected_input", "nhap_{slug}_sai_{letter}{3d}")]


def registry() -> list[tuple]:
    """All look-alike strategies, three for each label: of its own, or one of its own and two by rule."""
    own = [(f"{label.lower()}_as_{kind}", label, family, kind, t) for label, (family, kind, t) in OWN.items()]
    ruled = [(f"{label.lower()}_as_{kind}", label, family, kind, t.replace("{slug}", label.lower())) for label in OWN for family, kind, t in MORE_OWN.get(label, MORE)]
    out = []
    for name, label, family, kind, template in own + ruled:
        parts = templates.parse(template, LISTS)
        out.append((name, label, family, kind, template, templates.pattern(parts), *FAMILIES[family], [label], [], parts))
    return out


def strategies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(registry(), SCHEMA)


def look_alikes(keys: DataFrame, seed: int) -> DataFrame:
    """(strategy_id, key, value, fits) of keys (one column): a look-alike of every strategy for each key, and whether its strategy's
    pattern fits it. A batch of keys meets one strategy at a time, so that templates and patterns are taken apart once."""
    name, kind = keys.dtypes[0]
    made = [(r[0], r[5], [tuple(p.values()) for p in r[-1]]) for r in registry()]

    def draw(batches):
        for batch in batches:
            key = batch.column(0)
            said = key.cast(pa.string()).to_pylist()
            for strategy, pattern, parts in made:
                value = templates.drawn_batch(parts, f"{seed}|{strategy}", said)
                yield pa.RecordBatch.from_arrays([pa.array([strategy] * len(said)), key, value, pc.match_substring_regex(value, pattern)], names=["strategy_id", name, "value", "fits"])

    return keys.mapInArrow(draw, f"strategy_id string, `{name}` {kind}, value string, fits boolean")
