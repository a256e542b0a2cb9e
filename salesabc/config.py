"""Fixed business values and output schemas.

Everything in the "fixed values" blocks must equal the source system's
lookup data for results to match; it is kept here, as plain data, in its
natural order.  Nothing else in the package hard-codes business names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Store-name standardisation (raw name -> standard name).
# Unmapped names pass through unchanged.
# ---------------------------------------------------------------------------
STORE_NAMES: dict[str, str] = {
    "Amazon - Daril Vendas": "Amazon - Daril Vendas",
    "Amazon - LOJA DA MADA": "Amazon - Loja Da Mada",
    "Amazon - LOJA THITI": "Amazon - Loja Thiti",
    "Amazon - MEGAJU": "Amazon - Megaju",
    "Amazon - MEGA STAR SHOPP": "Amazon - Mega Star Shop",
    "Amazon - NANU SHOP": "Amazon - Nanu Shop",
    "Ali Express - LOJA THITI": "AliExpress - Loja Thiti",
    "Ali Express - NANU.SHOP": "AliExpress - Nanu Shop",
    "Kabum - JULISHOP": "Kabum - Julishop",
    "Mercado Livre - JULISHOP": "Mercado Livre - Julishop",
    "Mercado Livre -  LOJA_THITI": "Mercado Livre - Loja Thiti",
    "Mercado Livre - LOJA_THITI": "Mercado Livre - Loja Thiti",
    "Mercado Livre - MEGAJU": "Mercado Livre - Megaju",
    "Shopee - NANU SHOP": "Shopee - Nanu Shop",
    "Shopee - Loja_da_mada": "Shopee - Loja da Mada",
    "Shopee - Daril Vendas": "Shopee - Daril Vendas",
    "TikTok - NANU SHOP": "TikTok - Nanu Shop",
    "TikTok - LOJA DA MADA": "TikTok - Loja da Mada",
    "Magazine Luiza - Shop Midas": "Magazine Luiza - Shop Midas",
    "Shopify - Shopify": "Shopify - Shopify",
}

# ---------------------------------------------------------------------------
# Order-status standardisation (trimmed raw -> label).
# Unmapped statuses pass through (trimmed).
# ---------------------------------------------------------------------------
STATUS_LABELS: dict[str, str] = {
    "awaiting_send": "Ag. envio",
    "awaiting_logistic": "Ag. logística",
    "approved": "Aprovado",
    "canceled": "Cancelado",
    "delivered": "Entregue",
    "not_delivered": "Não Entregue",
    "ready_to_print": "Pronto para Impressão",
    "sent": "Enviado",
    "awaiting_invoice": "Ag. Nota Fiscal",
    "awaiting_approval": "Ag. Aprovação",
    "billed": "Faturado",
    "returned_logistic": "Logística Devolvida",
    "integration_error": "Erro Integração",
    "processing": "Processando",
    "awaiting_payment": "Ag. Pagamento",
    "canceled_resolved": "Cancelado e resolvido",
}

# ---------------------------------------------------------------------------
# Month names used in the Pareto month label MM/<name>/YYYY
# (January first; lower case, no cedilla in "marco").
# ---------------------------------------------------------------------------
MONTH_NAMES_PT: list[str] = [
    "janeiro", "fevereiro", "marco", "abril", "maio", "junho",
    "julho", "agosto", "setembro", "outubro", "novembro", "dezembro",
]

# ---------------------------------------------------------------------------
# Logistics classes.
# Raw logistic types that decide the class on their own, highest priority
# first, then the per-marketplace class, then the two low-priority raw types.
# ---------------------------------------------------------------------------
LOGISTICS_TOP_RAW: list[tuple[str, str]] = [
    ("self_service", "Envio Flex"),
    ("fulfillment", "Fulfillment"),
]
LOGISTICS_LOW_RAW: list[tuple[str, str]] = [
    ("drop_off", "Correios Outros"),
    ("xd_drop_off", "Coleta Outros"),
]
LOGISTICS_DEFAULT = "Outros"

# Pareto class thresholds on the running share (percent).
CLASS_A_MAX = "80.000"
CLASS_B_MAX = "95.000"

# Table-name prefix of the per-group Pareto tables.
PARETO_TABLE_PREFIX = "pareto"

# Default markers for feed items without sku/title.
MISSING_ITEM_MARK = "N/A"
MISSING_TITLE_PARETO = "Sem Título"


@dataclass(frozen=True)
class Marketplace:
    """A marketplace recognised by a store-name prefix."""

    prefix: str                 # store names starting with this belong to it
    logistics_class: str        # class assigned by store prefix (B3)
    recompute_revenue: bool     # revenue = unit price x quantity (B4)
    settles_orders: bool        # has settlement reports (S9/J3)
    priority: int               # higher wins when prefixes overlap (B3)


@dataclass(frozen=True)
class Profile:
    """Business profile: which prefixes mean which marketplace."""

    marketplaces: tuple[Marketplace, ...]
    overall_label: str = "PARETO_GERAL"
    extra_store_names: dict[str, str] = field(default_factory=dict)

    @property
    def group_prefixes(self) -> list[str]:
        return [m.prefix for m in self.marketplaces]

    @property
    def recompute_prefixes(self) -> list[str]:
        return [m.prefix for m in self.marketplaces if m.recompute_revenue]

    @property
    def settlement_prefixes(self) -> list[str]:
        return [m.prefix for m in self.marketplaces if m.settles_orders]


# The production profile.  In the store-prefix rule the
# later-applied marketplace wins: Mercado Livre < Shopee < Amazon.
DEFAULT_PROFILE = Profile(
    marketplaces=(
        Marketplace("Mercado Livre", "Mercado Envios", True, False, 1),
        Marketplace("Shopee", "Shopee Xpress", False, True, 2),
        Marketplace("Amazon", "Coleta Correios", True, False, 3),
    ),
)

# The synthetic test tables name stores "<region> - <nation>"; three regions
# play the three marketplaces (AMERICA as Mercado Livre, ASIA as Shopee,
# EUROPE as Amazon).
TEST_PROFILE = Profile(
    marketplaces=(
        Marketplace("AMERICA", "Mercado Envios", True, False, 1),
        Marketplace("ASIA", "Shopee Xpress", False, True, 2),
        Marketplace("EUROPE", "Coleta Correios", True, False, 3),
    ),
)

# ---------------------------------------------------------------------------
# Column sets and schemas
# ---------------------------------------------------------------------------

# Sales sheet: header -> column (fixed values).
SHEET_HEADERS: dict[str, str] = {
    "Número pedido": "numero_pedido",
    "Número pedido ERP": "numero_pedido_erp",
    "Número carrinho": "numero_carrinho",
    "Data do pedido": "data_do_pedido",
    "Loja": "loja",
    "SKU": "sku",
    "Valor total produto": "valor_total_produto",
    "Valor unitário venda": "valor_unitario_venda",
    "Quantidade": "quantidade",
    "Título": "titulo",
    "Id Canal Marketplace": "id_canal_marketplace",
    "Rastreio": "rastreio",
    "Status": "status",
    "Tipo logística": "tipo_logistica",
}

# Catalogue CSV columns (fixed values, in file order).
CATALOG_SHEET_COLUMNS = ["sku", "Produto", "UN", "Quantidade", "Valor unitario",
                         "Fornecedores", "Categoria", "Subcategoria", "tipo_de_venda"]
CATALOG_CSV_COLUMNS: list[str] = [
    "Código", "Produto", "UN", "Quantidade", "Valor unitario",
    "Fornecedores", "Categoria", "Subcategoria", "Tipo de Venda",
]

# Catalogue CSV header -> joined column (fixed values).
CATALOG_CSV_RENAME: dict[str, str] = {
    "Código": "sku",
    "Quantidade": "Estq",
    "Valor unitario": "custo_unitario",
    "Produto": "titulo_bling",
    "Fornecedor": "Fornecedores",
    "Tipo de Venda": "tipo_de_venda",
}

# Enrichment / catalogue sheet header -> column (fixed values).
CATALOG_SHEET_RENAME: dict[str, str] = {
    "Codigo": "sku",
    "Produto": "Produto",
    "Quantidade": "Quantidade",
    "Valor unitario": "Valor unitario",
    "Fornecedores": "Fornecedores",
    "Categoria": "Categoria",
    "Subcategoria": "Subcategoria",
    "Tipo de Venda": "tipo_de_venda",
}

# Settlement report header -> column (fixed values).
SETTLEMENT_HEADERS: dict[str, str] = {
    "ID do pedido": "id_pedido",
    "Compensar Moedas Shopee": "moedas",
    "Cupom Shopee": "cupom",
    "Taxa de comissão": "taxa_comissao",
    "Taxa de serviço": "taxa_servico",
    "Preço acordado": "preco_acordado",
}

MONEY = T.DecimalType(18, 3)     # working money
MONEY2 = T.DecimalType(18, 2)    # final fact money
SHARE = T.DecimalType(18, 3)     # percent shares

# Sales fact: 22 columns, in order.
FACT_SCHEMA = T.StructType([
    T.StructField("numero_pedido", T.StringType()),
    T.StructField("numero_pedido_erp", T.StringType()),
    T.StructField("numero_carrinho", T.StringType()),
    T.StructField("data_do_pedido", T.DateType()),
    T.StructField("hora_do_pedido", T.StringType()),
    T.StructField("loja", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("valor_total_produto", MONEY2),
    T.StructField("quantidade", T.LongType()),
    T.StructField("titulo", T.StringType()),
    T.StructField("id_canal_marketplace", T.StringType()),
    T.StructField("rastreio", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("tipo_logistica", T.StringType()),
    T.StructField("custo_unitario", MONEY2),
    T.StructField("custo_total_produto", MONEY2),
    T.StructField("Comissão", MONEY2),
    T.StructField("Fornecedores", T.StringType()),
    T.StructField("Estq", T.LongType()),
    T.StructField("Categoria", T.StringType()),
    T.StructField("Subcategoria", T.StringType()),
    T.StructField("tipo_de_venda", T.StringType()),
])
FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]

# Working sales frame: every column any source may carry, with the typed
# default used when a source lacks it (the "conform" rule).
WORK_DEFAULTS: dict[str, tuple[T.DataType, object]] = {
    "numero_pedido": (T.StringType(), ""),
    "numero_pedido_erp": (T.StringType(), ""),
    "numero_carrinho": (T.StringType(), ""),
    "data_do_pedido": (T.DateType(), None),
    "hora_do_pedido": (T.StringType(), ""),
    "loja": (T.StringType(), ""),
    "sku": (T.StringType(), ""),
    "valor_total_produto": (MONEY, "0.000"),
    "valor_unitario_venda": (MONEY, "0.000"),
    "quantidade": (T.LongType(), 0),
    "titulo": (T.StringType(), ""),
    "id_canal_marketplace": (T.StringType(), ""),
    "rastreio": (T.StringType(), ""),
    "status": (T.StringType(), ""),
    "tipo_logistica": (T.StringType(), ""),
    "custo_unitario": (MONEY, "0.000"),
    "custo_total_produto": (MONEY, "0.000"),
    "cashback_cupom": (MONEY, "0.000"),
    "Comissão": (MONEY, "0.000"),
    "Fornecedores": (T.StringType(), None),
    "Estq": (T.LongType(), 0),
    "Categoria": (T.StringType(), None),
    "Subcategoria": (T.StringType(), None),
    "tipo_de_venda": (T.StringType(), None),
    "origem_dados": (T.StringType(), ""),
}

# Pareto output: the 11 published columns plus the group and table slug.
PARETO_COLUMNS = [
    "mes_referencia", "sku", "titulo",
    "quantidade_total_vendida", "share_quantidade_vendas",
    "pareto_quantidade_acumulada", "curva_abc_quantidade",
    "valor_total_gmv", "share_gmv", "pareto_gmv_acumulado", "curva_abc_gmv",
]

# Order feed: page size of the landed pages.
FEED_PAGE_SIZE = 50
PRODUCT_PAGE_SIZE = 100
