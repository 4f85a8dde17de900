"""How a value of each label is written: own word lists and templates (see annolith.functions.templates)."""

from __future__ import annotations

from annolith.functions import templates
from annolith.functions.detect import CITIES

_WARDS = {
    "TP. Hồ Chí Minh": ["phường Bến Thành, Quận 1", "phường Đa Kao, Quận 1", "phường An Khánh, Thủ Đức", "phường Linh Tây, Thủ Đức"],
    "Đà Nẵng": ["phường Hòa Minh, quận Liên Chiểu", "phường Khuê Trung, quận Cẩm Lệ", "phường Mỹ An, quận Ngũ Hành Sơn"],
    "Hà Nội": ["phường Hàng Bạc, quận Hoàn Kiếm", "phường Láng Hạ, quận Đống Đa", "phường Bưởi, quận Tây Hồ"],
}
LISTS = {
    "family": ["Đinh", "Lý", "Mai", "Tô", "Tạ", "Cao", "Lương", "Châu", "Triệu", "Quách"],
    "middle": ["Hữu", "Gia", "Bảo", "Khánh", "Diệu", "Tường", "Xuân", "Hải"],
    "given": ["Duy", "Giang", "Hạnh", "Kiên", "Linh", "My", "Nhi", "Oanh", "Phong", "Quân", "Tâm", "Uyên", "Vinh", "Yến"],
    "city": list(CITIES),
    "district": list(dict.fromkeys(f"{ward.split(', ')[1]}, {city}" for city, wards in _WARDS.items() for ward in wards)),
    "ward": [f"{ward}, {city}" for city, wards in _WARDS.items() for ward in wards],
    "street": ["Hàm Nghi", "Phan Chu Trinh", "Yersin", "Võ Văn Tần", "Lý Tự Trọng", "Bạch Đằng"],
    "block": ["K1", "K2", "M3", "N4", "P5"],
    "mobile": ["033", "038", "058", "077", "089", "096"],
    "mobile_abroad": ["33", "38", "58", "77", "89", "96"],
    "plate": ["A", "B", "D", "E", "F"],
    "half": ["AM", "PM"],
    "illness": ["viêm xoang", "đau dạ dày", "tiểu đường", "rối loạn tiền đình", "thoái hóa khớp"],
    "honorific": ["Cô", "Chú", "Giáo sư", "Luật sư"],
    "gender": ["nam giới", "nữ giới", "khác"],
    "network": ["JCB", "UnionPay", "Amex"],
    "bank_code": ["VNBKVNVX", "ABCDSGSG", "TESTDEFF"],
    "job": ["thợ điện", "biên tập viên", "dược sĩ", "lái xe"],
    "marriage": ["chưa lập gia đình", "có gia đình", "góa"],
    "faith": ["Tin lành", "Cao Đài", "không tôn giáo"],
    "people": ["Nùng", "Ê Đê", "Chăm", "Khmer"],
    "country": ["Lào", "Hàn Quốc", "Pháp"],
    "letter": ["A", "B", "C", "D", "E", "G", "H"],
}

# The names of the format variants of labels that have several.
FORMAT_VARIANTS = {
    "PERSON": ["full_name", "family_given", "family_middle_given"],
    "PHONE": ["local_compact", "local_spaced", "international_spaced"],
    "EMAIL": ["dot_local", "hyphen_local", "plus_alias"],
    "ADDRESS": ["street", "apartment", "building"],
    "LOCATION": ["city", "district_city", "ward_district_city"],
    "DATE": ["dmy_slash", "iso_date", "dmy_hyphen"],
    "TIME": ["24h", "24h_seconds", "12h_meridiem"],
    "MONEY": ["amount_unit", "code_prefix", "symbol_prefix"],
    "URL": ["web_path", "subdomain_path", "api_endpoint"],
    "IP": ["ipv4_documentation", "ipv4_documentation", "ipv6_documentation"],
    "CARD_NUMBER": ["visa_test", "mastercard_test", "visa_alt_test"],
    "PLATE": ["car_standard", "motorbike", "spaced_dotted"],
    "PASSPORT": ["series_b", "series_c", "series_p"],
    "MEDICAL_INFO": ["medical_history", "current_treatment", "test_result"],
}

#: One template for each variant of a label, in the order of FORMAT_VARIANTS.
TEMPLATES = {
    "PERSON": ["{family} {middle} {given}", "{family} {given}", "{family} {given} {given}"],
    "PHONE": ["{mobile}{7d}", "{mobile} {3d} {4d}", "+84 {mobile_abroad} {3d} {4d}"],
    "EMAIL": ["thu.{7d}@example.org", "hop-thu-{7d}@example.net", "nhan+{7d}@example.com"],
    "ADDRESS": ["{1-480} đường {street}, {ward}", "Phòng {block}.{1-30:2}, {1-480} đường {street}, {ward}", "Nhà {block}, {1-480} đường {street}, {ward}"],
    "LOCATION": ["{city}", "{district}", "{ward}"],
    "DATE": ["{1-28:2}/{1-12:2}/{2018-2034}", "{2018-2034}-{1-12:2}-{1-28:2}", "{1-28:2}-{1-12:2}-{2018-2034}"],
    "TIME": ["{0-23:2}:{0-59:2}", "{0-23:2}:{0-59:2}:{0-59:2}", "{1-12:2}:{0-59:2} {half}"],
    "MONEY": ["{1-899}.{3d}.000 VND", "VND {1-899},{3d},000", "₫{1-899},{3d}"],
    "URL": ["https://example.org/muc/{9d}", "https://cong.example.net/don/{9d}", "http://dich-vu.example.com/v2/{9d}"],
    "IP": ["203.0.113.{1-254}", "192.0.2.{1-254}", "2001:db8:{3h}:{3h}::2"],
    "CARD_NUMBER": ["453201{9d}{luhn}", "510510{9d}{luhn}", "402400{9d}{luhn}"],
    "PLATE": ["{11-99}{plate}-{5d}", "{11-99}{plate}1-{5d}", "{11-99}{plate} {3d}.{2d}"],
    "PASSPORT": ["B{8d}", "C{8d}", "P{7d}"],
    "MEDICAL_INFO": ["từng mắc {illness}", "uống thuốc vì {illness}", "phiếu khám ghi {illness}"],
    "PREFIX": ["{honorific}"],
    "GENDER": ["{gender}"],
    "AGE": ["{19-79} tuổi"],
    "BIRTHDATE": ["{1-28:2}/{1-12:2}/{1946-2007}"],
    "ZIP_CODE": ["{100000-999999}"],
    "COORDINATE": ["{9-22}.{6d}, {103-109}.{6d}"],
    "USERNAME": ["ban_doc_{7d}"],
    "ACCOUNT_ID": ["ACC-{9d}"],
    "TICKET_ID": ["INC-{6d}"],
    "PASSWORD": ["Khoa#{7d}zQ"],
    "PIN": ["{4d}"],
    "API_KEY": ["khoa_thu_{24h}"],
    "BANK_ACCOUNT": ["{13d}"],
    "CARD_ISSUER": ["{network}"],
    "CVV": ["{3d}"],
    "IBAN": ["FR76{15d}{8d}"],
    "SWIFT": ["{bank_code}"],
    "WALLET": ["0x{20h}{20h}"],
    "JOB_TITLE": ["{job}"],
    "ORGANIZATION": ["Hợp tác xã Mẫu Số {5d}"],
    "EMPLOYEE_ID": ["EMP-{7d}"],
    "NATIONAL_ID": ["0{11d}"],
    "LICENSE": ["GPLX {10d}"],
    "TIN": ["8{9d}"],
    "MARITAL": ["{marriage}"],
    "RELIGION": ["{faith}"],
    "ETHNICITY": ["{people}"],
    "TRADE_UNION": ["Nghiệp đoàn Mẫu Số {4d}"],
    "NATIONALITY": ["{country}"],
    "INSURANCE_ID": ["BH-{9d}"],
}

#: label -> [(variant, parts)]
PARSED = {label: [(name, templates.parse(t, LISTS)) for name, t in zip(FORMAT_VARIANTS.get(label, ["default"]), made, strict=True)] for label, made in TEMPLATES.items()}
