"""Schemas of the records that cross a boundary. Nothing is inferred at read."""

from __future__ import annotations

HOC_PHAN = (
    "ma_hoc_phan string, ten_vi string, ten_en string, mo_ta_tom_tat string, mo_ta_tom_tat_en string, so_tin_chi_tong int, "
    "ctdt_memberships array<struct<ma_ctdt:string,nhom_id:string,loai_nhom:string>>, source_hash string"
)
CLO = "ma_cdr_goc string, ma_clo string, noi_dung string, noi_dung_en string, pi_so array<string>, muc_do string, source_hash string"
BAI_HOC = "ten_bai string, ten_bai_en string, noi_dung_tom_tat string, noi_dung_tom_tat_en string, ma_clo array<string>, source_hash string"
MUC_TIEU = "ma_muc_tieu string, loai_muc_tieu string, noi_dung string, noi_dung_en string, so_ctdt array<string>, source_hash string"
CONTRACT = {"hoc_phan": HOC_PHAN, "clo": CLO, "bai_hoc": BAI_HOC, "muc_tieu": MUC_TIEU}
MENTION = "text string, evidence_id string, source string, head_type string, confidence double, char_start int, char_end int, source_text string"
OCCUPATIONS = ("conceptUri", "code", "preferredLabel", "altLabels", "description", "definition", "iscoGroup")
SKILLS = ("conceptUri", "preferredLabel", "skillType", "reuseLevel", "description", "definition", "altLabels")
RELATIONS = ("occupationUri", "occupationLabel", "relationType", "skillType", "skillUri", "skillLabel")
PROGRAMME = (
    "ma_ctdt string, crawl_course_key string, chuong_trinh_dao_tao struct<ma_ctdt:string,ten_ctdt:string,bac_dao_tao:string,phien_ban:string>, "
    "nhom_hoc_phan array<struct<ten_nhom:string,loai_nhom:string,so_tin_chi_yeu_cau:double,hoc_phan:array<struct<ma_hoc_phan:string,"
    "ten_hoc_phan:string,so_tin_chi_tong:double,hoc_ky_goi_y:int,quan_he:array<struct<loai:string,ma_hoc_phan:string,ten_hoc_phan:string>>>>>>"
)
METADATA = "uri string, label string, description string, skill_type string"
ENVELOPE = "entity_id string, entity_type string, ma_hoc_phan string, source_file string, source_hash string, review_status string, data string"
