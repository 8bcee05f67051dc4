"""Codes, names and column lists that results depend on. All are fixed values."""

# State codes and names.
STATES = [
    ("1", "ANDHRA PRADESH"),
    ("2", "ARUNACHAL PRADESH"),
    ("3", "ASSAM"),
    ("4", "BIHAR"),
    ("5", "GOA"),
    ("6", "GUJARAT"),
    ("7", "HARYANA"),
    ("8", "HIMACHAL PRADESH"),
    ("9", "JAMMU AND KASHMIR"),
    ("10", "KARNATAKA"),
    ("11", "KERALA"),
    ("12", "MADHYA PRADESH"),
    ("13", "MAHARASHTRA"),
    ("14", "MANIPUR"),
    ("15", "MEGHALAYA"),
    ("16", "MIZORAM"),
    ("17", "NAGALAND"),
    ("18", "ODISHA"),
    ("19", "PUNJAB"),
    ("20", "RAJASTHAN"),
    ("21", "SIKKIM"),
    ("22", "TAMIL NADU"),
    ("23", "TRIPURA"),
    ("24", "UTTAR PRADESH"),
    ("24A", "UP-NCR"),
    ("25", "WEST BENGAL"),
    ("26", "ANDAMAN AND NICOBAR"),
    ("27", "CHANDIGARH"),
    ("28", "DADRA AND NAGAR HAVE"),
    ("29", "Daman and Diu"),
    ("30", "DELHI"),
    ("31", "LAKSHADWEEP"),
    ("32", "PONDICHERRY"),
    ("33", "CHHATTISGARH"),
    ("34", "JHARKHAND"),
    ("35", "UTTARAKHAND"),
    ("36", "TELANGANA"),
    ("37", "Not defined in SAP"),
    ("38", "LADAKH"),
    ("A1", "Not defined in SAP"),
    ("A2", "Not defined in SAP"),
    ("A3", "Not defined in SAP"),
    ("A4", "Not defined in SAP"),
    ("KM", "SRINAGAR"),
]

# Sales-force extract fields and their business names.
SALES_FORCE_NAMES = {
    "KUNNR": "customer_code",
    "KUNR1": "ss_custome",
    "FSSIV": "fssi_valid",
    "INPLN": "invst._amt",
    "WAERS": "crcy",
    "ASSDT": "asscn._dat",
    "ASSYR": "no._of_yrs",
    "BSCTS": "biscuits",
    "CKNCK": "cakes",
    "BOTH0": "cookies",
    "RUSK0": "rusk",
    "PANCD": "pan_card",
    "FOODL": "food_licen",
    "GSTIN": "gstin",
    "PDC_1": "pdc_chq._1",
    "PDC_2": "pdc_chq._2",
    "PDC_3": "pdc_chq._3",
    "BANKN": "bank_name",
    "MSME1": "miscellane",
    "SONAME": "so_name",
    "EMPCD1": "so_emp_code",
    "SMTP_1": "so_email",
    "DATE1": "date",
    "ASMNAME": "asm_name",
    "EMPCD2": "asm_emp_code",
    "SMTP_2": "asm_email",
    "DATE2": "asm_code_creation_date",
    "RSMNAME": "rsm_name",
    "EMPCD3": "rsm_emp_code",
    "SMTP_3": "rsm_email",
    "DATE3": "rsm_code_creation_date",
    "NWUPD": "new/update",
    "REGDT": "reg._date",
    "ZSMNAME": "zsm_name",
    "EMPCD5": "zsm_emp_code",
    "ZSMMAIL": "zsm_email",
    "DATE5": "zsm_code_creation_date",
    "NSMNAME": "nsm_name",
    "EMPCD6": "nsm_emp_code",
    "NSMMAIL": "nsm_email",
    "DATE6": "nsm_code_creation_date",
    "DSM_CODE": "dsm_code",
    "DSM_NAME": "dsm_name",
    "DSM_MAIL": "dsm_mail",
    "SR_CODE": "sr_code",
    "SR_NAME": "sr_name",
    "SR_MAIL": "sr_mail",
    "MANDT": "company_code",
}

# Material fields kept in the master and their business names.
MATERIAL_NAMES = {
    "MATNR": "material_number",
    "ERSDA": "created_on",
    "CREATED_AT_TIME": "created_on_time",
    "ERNAM": "name_of_person_who_created_the_object",
    "LAEDA": "date_of_last_change",
    "AENAM": "name_of_person_who_changed_object",
    "VPSTA": "maintenance_status_of_complete_material",
    "PSTAT": "maintenance_status",
    "LVORM": "flag_material_for_deletion_at_client_level",
    "MTART": "material_type",
    "MBRSH": "industry_sector",
    "MATKL": "material_group",
    "BISMT": "old_material_number",
    "MEINS": "base_unit_of_measure",
    "BSTME": "purchase_order_unit_of_measure",
    "BRGEW": "gross_weight",
    "NTGEW": "net_weight",
    "GEWEI": "weight_unit",
    "VOLUM": "volume",
    "VOLEH": "volume_unit",
    "DISST": "low-level_code",
    "TRAGR": "transportation_group",
    "STOFF": "hazardous_material_number",
    "SPART": "division",
    "WESCH": "quantity:_number_of_gr/gi_slips_to_be_printed",
    "GEWTO": "excess_weight_tolerance_for_handling_unit",
    "VOLTO": "excess_volume_tolerance_of_the_handling_unit",
    "VABME": "variable_purchase_order_unit_active",
    "KZREV": "revision_level_has_been_assigned_to_the_material",
    "KZKFG": "configurable_material",
    "XCHPF": "batch_management_requirement_indicator",
    "VHART": "packaging_material_type",
    "FUELG": "maximum_level_(by_volume)",
    "STFAK": "stacking_factor",
    "MAGRV": "material_group_packaging_materials",
    "EXTWG": "external_material_group",
    "MHDRZ": "minimum_remaining_shelf_life",
    "MHDHB": "total_shelf_life",
    "MHDLP": "storage_percentage",
    "INHME": "content_unit",
    "INHAL": "net_contents",
    "VPREH": "comparison_price_unit",
    "IPRKZ": "period_indicator_for_shelf_life_expiration_date",
    "RDMHD": "rounding_rule_for_calculation_of_sled",
    "PRZUS": "indicator:_product_composition_printed_on_packaging",
    "MTPOS_MARA": "general_item_category_group",
    "BFLME": "generic_material_with_logistical_variants",
    "MATFI": "material_is_locked",
    "CMREL": "relevant_for_configuration_management",
    "BBTYP": "assortment_list_type",
    "SLED_BBD": "expiration_date",
    "MAXC": "maximum_allowed_capacity_of_packaging_material",
    "MAXC_TOL": "overcapacity_tolerance_of_the_handling_unit",
    "LAST_CHANGED_TIME": "chgd.time",
    "MATNR_EXTERNAL": "material",
    "CHML_CMPLNC_RLVNCE_IND": "chemicalcompliancerelevanceindicator",
    "SCM_MATID_GUID16": "product",
    "SCM_MATID_GUID22": "productid",
    "OVERHANG_TRESH": "threshold",
    "BRIDGE_TRESH": "bridge",
    "BRIDGE_MAX_SLOPE": "max.slope",
    "/SAPMP/KADU": "cabledia.",
    "/SAPMP/ABMEIN": "u.fordim.",
    "/SAPMP/KADP": "ballow",
    "/SAPMP/BRAD": "bendfactor",
    "/SAPMP/SPBI": "innerwidth",
    "/SAPMP/TRAD": "outerdia.",
    "/SAPMP/KEDU": "coredia.",
    "/SAPMP/SPTR": "loadcap.",
    "/SAPMP/FBDK": "rofthick.",
    "/SAPMP/FBHK": "rofheight",
    "/SAPMP/MIFRR": "clearance",
    "/STTPEC/SERTYPE": "ser.type",
    "RIC_ID": "ricid",
    "ZZBRD": "brand",
    "ZZPBD": "prodbrand",
    "ZZMRP": "mrp",
    "ZZPCT": "prodcat",
    "ZZSZE": "packsize",
    "ZZFMT": "format",
    "ZZMRPCB": "mrp/cb",
    "ZZNOBIS": "no_bisc_pk",
    "ZZSECPK": "sec.pack",
    "ZZSECQTY": "secondarypackqty",
    "ZZSECTYP": "sec_pktyp",
    "ZZTRADPT": "tradept",
    "ZZREMARK": "remarks",
    "ZZBCODE": "barcode",
    "ZZBFLV": "brandflav",
}

# Columns of the sales register, in order.
REGISTER_COLUMNS = [
    "customer_group",
    "customer_code",
    "material_code",
    "exception_key",
    "item_category",
    "material_description",
    "UoM",
    "product_category",
    "product_brand",
    "brand_flavour",
    "mrp",
    "pack_size",
    "pack_format",
    "mrp_cb",
    "no_of_bisc_pk",
    "secondary_pack_qty",
    "secondary_pkt_type",
    "material_group",
    "business_segment",
    "customer_name",
    "region",
    "state_code",
    "district",
    "zone",
    "zsm_emp_code",
    "zsm",
    "zsm_email",
    "rsm_emp_code",
    "rsm",
    "rsm_email",
    "asm_emp_code",
    "asm",
    "asm_email",
    "so_emp_code",
    "so",
    "so_email",
    "town_villa",
    "customer_group_description",
    "mrp_group",
    "trade",
    "brand_billed",
    "distributors",
    "distributors_category",
    "customer_budget",
    "focus_brand",
    "state_name",
    "type",
    "80_20 rule",
    "billing_month",
    "brand_billing_amount",
    "contribution",
    "MTD",
    "LYMTD",
    "growth_percentage_MTD_vs_LYMTD",
    "LM",
    "LMMTD",
    "growth_percentage_MTD_Vs_LMMTD",
    "L2M",
    "L2MMTD",
    "growth__percentage_MTD_Vs_L2MMTD",
    "MTD_per_day",
    "MTD_CB",
    "LYMTD_CB",
    "growth_percentage_MTD_vs_LYMTD_CB",
    "LM_CB",
    "LMMTD_CB",
    "growth_percentage_MTD_Vs_LMMTD_CB",
    "L2M_CB",
    "L2MMTD_CB",
    "growth__percentage_MTD_Vs_L2MMTD_CB",
    "MTD_per_day_CB",
    "MTD_MT",
    "LYMTD_MT",
    "growth_percentage_MTD_vs_LYMTD_MT",
    "LM_MT",
    "LMMTD_MT",
    "growth_percentage_MTD_Vs_LMMTD_MT",
    "L2M_MT",
    "L2MMTD_MT",
    "growth__percentage_MTD_Vs_L2MMTD_MT",
    "MTD_per_day_MT",
    "current_date",
    "LY_end_date",
    "LY_first_date_month",
    "L1MTD_first_date_month",
    "L1MTD_end_date",
    "L2MTD_first_date_month",
    "L2MTD_end_date",
    "LM_first_date_month",
    "LM_end_date",
    "LMTD_first_date_month",
    "LMTD_end_date",
    "L2M_AVG_first_date_month",
    "L2M_AVG_end_date",
    "current_fy_start",
    "current_fy_end",
    "last_fy_start",
    "last_fy_end",
    "YTD",
    "YTD_MT",
    "YTD_CB",
    "LYTD",
    "LYTD_MT",
    "LYTD_CB",
    "day_lapsed",
    "growth_percentage_YTD_vs_LYTD",
    "growth_percentage_YTD_Vs_LYTD_CB",
    "growth__percentage_YTD_Vs_LYTD_MT",
    "damage_value",
    "damage_doc_count",
    "average_billing_amount",
]

# Customer groups that the sales reports cover.
REPORTED_GROUPS = [
    "CP", "DE", "DL", "EC", "EX", "IS", "JM", "MD", "MS", "MT", "PL", "RL", "SN", "SS",
]

# Trade channel of a customer group; every other group is Others(OT).
TRADE_CHANNELS = [
    (["DL", "MD", "MS", "SS", "RL", "CP"], "General Trade(GT)"),
    (["MT", "EC"], "Modern Trade(MT)"),
    (["DE", "EX"], "Export(EX)"),
    (["PL"], "PL"),
]
OTHER_TRADE = "Others(OT)"

# Billing types whose positive amounts turn negative, and the returns among them.
CREDIT_TYPES = ["ZREM", "RE", "ZMRE", "ZDR1"]
RETURN_TYPES = ["ZREM", "RE"]

# Material segments reported as one.
MERGED_SEGMENTS = ["BISC", "COOK"]
MERGED_SEGMENT_LABEL = "BISCUIT & COOKIES"

# Labels of focus brands and of all others.
FOCUS_LABEL = "Growth Driver Brand"
OTHER_LABEL = "Others"

# Column names of states, of customers and of the sales team, as they must appear.
STATE_COLUMNS = ["state_code", "state_name"]
CUSTOMER_FIELDS = {
    "KUNNR": "customer_code",
    "NAME1": "customer_name",
    "REGIO": "state_code",
    "AUFSD": "central_block_code",
    "ZZDT": "district",
    "ZZTN": "town_village",
    "ZZGP": "region",
    "ZZML": "block_tehsil",
    "ZZONE": "zone",
}
CUSTOMER_PROPER = ["customer_name", "district", "town_village", "region", "block_tehsil"]
SALES_TEAM = [
    "so_name",
    "asm_name",
    "rsm_name",
    "zsm_name",
    "so_email",
    "asm_email",
    "rsm_email",
    "zsm_email",
]
FORCE_PROPER = [
    "so_name",
    "asm_name",
    "rsm_name",
    "zsm_name",
    "nsm_name",
    "dsm_name",
    "sr_name",
]

# Fields of billing headers and items, and which of them are numbers.
HEADER_FIELDS = {
    "VBELN": "billing_document",
    "FKDAT": "billing_date",
    "FKART": "billing_type",
    "KDGRP": "customer_group",
    "KUNAG": "customer_code",
    "XBLNR": "ref_invoice_number",
}
ITEM_FIELDS = {
    "PRCTR": "profit_center",
    "WERKS": "plant",
    "PSTYV": "item_category",
    "VKORG_AUFT": "sales_org",
    "MWSBP": "tax_amount",
    "VBELN": "billing_document",
    "POSNR": "billing_item",
    "MATNR": "material_code",
    "ARKTX": "material_description",
    "FKIMG": "quantity",
    "VRKME": "UoM",
    "FKLMG": "billed_quantity",
    "NETWR": "net_value",
    "NTGEW": "qty_in_kg",
}
NUMBERS = ["tax_amount", "quantity", "billed_quantity", "qty_in_kg", "net_value"]

# The extracts by their delimiter.
CARET_TABLES = ["T151T", "KNA1", "MARA", "ZCUST_ADD_DETAIL", "MARC", "CEPC", "VBRP", "VBRK", "KNVV"]
COMMA_TABLES = ["focus_brand", "customer_budget", "Asm_Budget", "material_budget"]

# Customer columns that each sales-force row takes over.
FORCE_CUSTOMER_COLUMNS = [
    "customer_name", "block_status", "zone", "region", "state_code", "town_village", "district",
    "state_name",
]

# Sales-force columns of the register, old name to new.
REGISTER_FORCE_COLUMNS = {
    "customer_code": "customer_code",
    "customer_name": "customer_name",
    "region": "region",
    "state_code": "state_code",
    "district": "district",
    "zone": "zone",
    "zsm_emp_code": "zsm_emp_code",
    "zsm_email": "zsm_email",
    "rsm_emp_code": "rsm_emp_code",
    "rsm_email": "rsm_email",
    "asm_emp_code": "asm_emp_code",
    "asm_email": "asm_email",
    "so_emp_code": "so_emp_code",
    "so_email": "so_email",
    "town_village": "town_villa",
    "zsm_name": "zsm",
    "rsm_name": "rsm",
    "asm_name": "asm",
    "so_name": "so",
}

# Material columns of the register, old name to new.
REGISTER_MATERIAL_COLUMNS = {
    "material_number": "material_code",
    "prodcat": "product_category",
    "prodbrand": "product_brand",
    "brandflav": "brand_flavour",
    "mrp": "mrp",
    "packsize": "pack_size",
    "format": "pack_format",
    "mrp/cb": "mrp/cb",
    "no_bisc_pk": "no_of_bisc/pk",
    "secondarypackqty": "secondary_pack_qty",
    "sec_pktyp": "secondary_pkt_type",
    "material_group": "material_group",
    "new_segment": "business_segment",
}
