"""Table layouts of the bronze and silver layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The tables, their columns, types, lengths and required columns.
BRONZE_DDL = {
    "crm_cust_info": """
        cst_id int, cst_key varchar(50), cst_firstname varchar(50), cst_lastname varchar(50),
        cst_marital_status varchar(50), cst_gndr varchar(50), cst_create_date date""",
    "crm_prd_info": """
        prd_id int, prd_key varchar(50), prd_nm varchar(50), prd_cost int, prd_line varchar(50),
        prd_start_dt timestamp_ntz, prd_end_dt timestamp_ntz""",
    "crm_sales_details": """
        sls_ord_num varchar(50), sls_prd_key varchar(50), sls_cust_id int, sls_order_dt int,
        sls_ship_dt int, sls_due_dt int, sls_sales int, sls_quantity int, sls_price int""",
    "erp_loc_a101": "cid varchar(50), cntry varchar(50)",
    "erp_cust_az12": "cid varchar(50), bdate date, gen varchar(50)",
    "erp_px_cat_g1v2": """
        id varchar(50), cat varchar(50), subcat varchar(50), maintenance varchar(50)""",
}
SILVER_DDL = {
    "crm_cust_info": """
        cst_id int not null, cst_key varchar(50) not null, cst_firstname varchar(50),
        cst_lastname varchar(50), cst_marital_status varchar(50), cst_gndr varchar(50),
        cst_create_date date""",
    "crm_prd_info": """
        prd_id int not null, cat_id varchar(50), prd_key varchar(50) not null,
        prd_nm varchar(100), prd_cost decimal(18,2), prd_line varchar(50),
        prd_start_dt date, prd_end_dt date""",
    "crm_sales_details": """
        sls_ord_num varchar(50) not null, sls_prd_key varchar(50) not null,
        sls_cust_id int not null, sls_order_dt date, sls_ship_dt date, sls_due_dt date,
        sls_sales decimal(18,2), sls_quantity int, sls_price decimal(18,2)""",
    "erp_loc_a101": "cid varchar(50) not null, cntry varchar(50)",
    "erp_cust_az12": "cid varchar(50) not null, bdate date, gen varchar(50)",
    "erp_px_cat_g1v2": """
        id varchar(50) not null, cat varchar(50), subcat varchar(50),
        maintenance varchar(50)""",
}
LINEAGE_DDL = (
    "dwh_load_datetime timestamp_ntz default localtimestamp(), "
    "dwh_source_system varchar(50), dwh_batch_id int"
)
LINEAGE_COLUMNS = ("dwh_load_datetime", "dwh_source_system", "dwh_batch_id")

LAYERS = ("bronze", "silver", "gold")
# Load order: the CRM tables, then the ERP tables.
TABLES = tuple(BRONZE_DDL)


@dataclass(frozen=True)
class TableSpec:
    """One warehouse table: its name, the system it comes from and its layouts."""

    name: str

    @property
    def source_system(self) -> str:
        return self.name.split("_", 1)[0].upper()

    def ddl(self, layer: str) -> str:
        if layer == "bronze":
            return BRONZE_DDL[self.name]
        return f"{SILVER_DDL[self.name]}, {LINEAGE_DDL}"

    def declared(self, layer: str) -> T.StructType:
        """Declared types, lengths and required columns, without lineage columns."""
        return T.StructType.fromDDL({"bronze": BRONZE_DDL, "silver": SILVER_DDL}[layer][self.name])

    def readable(self, layer: str) -> T.StructType:
        """The declared layout with plain strings and nullable columns, as readers need."""
        return T.StructType(
            [
                T.StructField(
                    f.name,
                    T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType,
                )
                for f in self.declared(layer)
            ]
        )


SPECS = {name: TableSpec(name) for name in TABLES}
