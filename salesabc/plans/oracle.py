"""Independent DuckDB SQL for every registered query.

Each statement recomputes the query from the raw test tables with plain
SQL, so the Spark code is checked against a second implementation, not
against itself.  Money stays DECIMAL until the final projection; shares
use exact integer arithmetic on thousandths (HALF_UP); outputs are cast
to the interchange types used by the registry (DOUBLE for decimals,
ISO text for dates).
"""

from __future__ import annotations

from salesabc import config

P = config.TEST_PROFILE
OVERALL = P.overall_label
D3 = "DECIMAL(18,3)"

# Fixed values, written out here so that a wrong constant of the library shows.
STORE_NAMES = {
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
STATUS_LABELS = {
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
LOGISTICS_TOP_RAW = [("self_service", "Envio Flex"), ("fulfillment", "Fulfillment")]
LOGISTICS_LOW_RAW = [("drop_off", "Correios Outros"), ("xd_drop_off", "Coleta Outros")]
LOGISTICS_DEFAULT = "Outros"
MONTH_NAMES = ["janeiro", "fevereiro", "marco", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]

# ---------------------------------------------------------------------------
# Shared views
# ---------------------------------------------------------------------------

STORE = """
store AS (
  SELECT c_custkey, c_mktsegment, r_name, r_name || ' - ' || n_name AS loja
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
)"""

SALES_LINES = STORE + """,
sales_lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS numero_pedido,
         'ERP-' || CAST(l_orderkey AS VARCHAR) AS numero_pedido_erp,
         CAST(o_custkey AS VARCHAR) AS numero_carrinho,
         CAST(o_orderdate AS DATE) AS data_do_pedido,
         s.loja,
         CAST(l_partkey AS VARCHAR) AS sku,
         CAST(l_extendedprice AS DECIMAL(18,3)) AS valor_total_produto,
         CAST(p_retailprice AS DECIMAL(18,3)) AS valor_unitario_venda,
         CAST(l_quantity AS BIGINT) AS quantidade,
         p_name AS titulo,
         c_mktsegment AS id_canal_marketplace,
         'BR' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS rastreio,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'sent'
              WHEN 'P' THEN 'custom_p' ELSE o_orderstatus END AS status,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'fulfillment' WHEN '2' THEN 'self_service'
              WHEN '3' THEN 'xd_drop_off' WHEN '4' THEN 'drop_off' ELSE 'other' END AS tipo_logistica,
         s.r_name AS regiao, l_returnflag, l_tax, l_discount, o_totalprice, l_suppkey,
         l_orderkey, l_shipdate, l_linenumber, l_quantity, l_extendedprice, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                JOIN store s ON o_custkey = s.c_custkey
                JOIN part ON l_partkey = p_partkey
)"""

# Ingest order of lines (ascending = file order).
LINE_ORDER = ("l_orderkey, l_shipdate, l_linenumber, l_suppkey, l_quantity, l_extendedprice, "
              "l_discount, l_tax, l_returnflag, l_linestatus")
LINE_ORDER_DESC = ", ".join(c.strip() + " DESC" for c in LINE_ORDER.split(","))


def group_list(loja: str = "loja") -> str:
    """SQL list of the Pareto groups of a store (store, marketplaces, overall)."""
    parts = [loja] + [f"CASE WHEN starts_with({loja}, '{m}') THEN '{m}' END" for m in P.group_prefixes]
    parts.append(f"'{OVERALL}'")
    return f"list_distinct(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL))"


MONTHS_PT = "[" + ", ".join(f"'{m}'" for m in MONTH_NAMES) + "]"


def month_label(d: str) -> str:
    return f"strftime({d}, '%m') || '/' || {MONTHS_PT}[month({d})] || '/' || strftime({d}, '%Y')"


def share_milli(v: str, total: str) -> str:
    """HALF_UP(v*100/total, 3 places) in thousandths, exact, sign-aware."""
    vm = f"CAST(abs({v}) * 1000 AS HUGEINT)"
    tm = f"CAST(abs({total}) * 1000 AS HUGEINT)"
    q = f"(({vm}) * 200000 + {tm}) // (2 * {tm})"
    return (f"(CASE WHEN {total} = 0 THEN 0 WHEN ({v} < 0) <> ({total} < 0) THEN -{q} ELSE {q} END)")


def milli_to_double(m: str) -> str:
    return f"CAST(CAST({m} AS DECIMAL(18,0)) * 0.001 AS DOUBLE)"


def abc(run_milli: str) -> str:
    return f"CASE WHEN {run_milli} <= 80000 THEN 'A' WHEN {run_milli} <= 95000 THEN 'B' ELSE 'C' END"


def pareto_sql(source_cte: str, source: str) -> str:
    """Pareto over a CTE ``source`` with loja, sku, titulo, quantidade,
    valor_total_produto, data_do_pedido."""
    return f"""
WITH {source_cte},
lines AS (
  SELECT coalesce(loja, '') AS loja, CAST(date_trunc('month', data_do_pedido) AS DATE) AS mes_data,
         sku, coalesce(titulo, '{config.MISSING_TITLE_PARETO}') AS titulo,
         quantidade, valor_total_produto AS v
  FROM {source} WHERE data_do_pedido IS NOT NULL
),
exploded AS (
  SELECT unnest({group_list('loja')}) AS grupo, mes_data, sku, titulo, quantidade, v FROM lines
),
tot AS (
  SELECT grupo, mes_data, sku, titulo,
         CAST(sum(quantidade) AS {D3}) AS q, CAST(round(sum(v), 3) AS {D3}) AS g
  FROM exploded GROUP BY grupo, mes_data, sku, titulo
),
sh AS (
  SELECT *,
    {share_milli('q', 'sum(q) OVER (PARTITION BY grupo, mes_data)')} AS q_share,
    {share_milli('g', 'sum(g) OVER (PARTITION BY grupo, mes_data)')} AS g_share
  FROM tot
),
run AS (
  SELECT *,
    sum(q_share) OVER (PARTITION BY grupo, mes_data ORDER BY q DESC, sku, titulo
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS q_run,
    sum(g_share) OVER (PARTITION BY grupo, mes_data ORDER BY g DESC, sku, titulo
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g_run
  FROM sh
)"""


def pareto_select(run: str = "run") -> str:
    return f"""
SELECT grupo, strftime(mes_data, '%Y-%m') AS mes, {month_label('mes_data')} AS mes_referencia,
       sku, titulo,
       CAST(q AS DOUBLE) AS quantidade_total_vendida,
       {milli_to_double('q_share')} AS share_quantidade_vendas,
       {milli_to_double('q_run')} AS pareto_quantidade_acumulada,
       {abc('q_run')} AS curva_abc_quantidade,
       CAST(g AS DOUBLE) AS valor_total_gmv,
       {milli_to_double('g_share')} AS share_gmv,
       {milli_to_double('g_run')} AS pareto_gmv_acumulado,
       {abc('g_run')} AS curva_abc_gmv
FROM {run}"""


def slug(c: str) -> str:
    s = f"lower({c})"
    for a, b in ((" ", "_"), ("-", "_"), (".", ""), ("/", "_"), ("__", "_")):
        s = f"replace({s}, '{a}', '{b}')"
    s = f"regexp_replace({s}, '_$', '')"
    return f"regexp_replace({s}, '^_', '')"


def fold(c: str) -> str:
    return f"trim(regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '', 'g'))"


def milli_text(m: str) -> str:
    return f"CAST(CAST(CAST({m} AS DECIMAL(18,0)) * 0.001 AS {D3}) AS VARCHAR)"


ORACLE: dict[str, str] = {}

ORACLE["pareto_abc"] = pareto_sql(SALES_LINES, "sales_lines") + pareto_select()
ORACLE["pareto_abc_range"] = ORACLE["pareto_abc"]

ORACLE["pareto_table_text"] = pareto_sql(SALES_LINES, "sales_lines") + f"""
SELECT 'pareto_' || {slug('grupo')} AS tabela, grupo, strftime(mes_data, '%Y-%m') AS mes,
       {month_label('mes_data')} AS mes_referencia, {fold('sku')} AS sku, {fold('titulo')} AS titulo,
       CAST(q AS VARCHAR) AS quantidade_total_vendida,
       {milli_text('q_share')} AS share_quantidade_vendas,
       {milli_text('q_run')} AS pareto_quantidade_acumulada,
       {abc('q_run')} AS curva_abc_quantidade,
       CAST(g AS VARCHAR) AS valor_total_gmv,
       {milli_text('g_share')} AS share_gmv,
       {milli_text('g_run')} AS pareto_gmv_acumulado,
       {abc('g_run')} AS curva_abc_gmv
FROM run"""

ORACLE["missing_months"] = f"""
WITH {SALES_LINES},
dated AS (
  SELECT unnest({group_list("coalesce(loja, '')")}) AS grupo,
         CAST(date_trunc('month', data_do_pedido) AS DATE) AS mes_data
  FROM sales_lines WHERE data_do_pedido IS NOT NULL
),
present AS (SELECT DISTINCT grupo, mes_data FROM dated),
groups AS (SELECT DISTINCT grupo FROM dated),
months AS (SELECT DISTINCT mes_data FROM dated)
SELECT g.grupo, strftime(m.mes_data, '%Y-%m') AS mes, {month_label('m.mes_data')} AS mes_referencia
FROM groups g CROSS JOIN months m
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.grupo = g.grupo AND p.mes_data = m.mes_data)"""


# ---------------------------------------------------------------------------
# Cleaning rules (B1-B4) as SQL expressions
# ---------------------------------------------------------------------------

WS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11) || chr(160) || chr(8195)"


def strip(c: str) -> str:
    return f"trim({c}, {WS})"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lookup(c: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {c} {whens} ELSE {c} END)"


def std_store(c: str = "loja") -> str:
    return lookup(f"coalesce({strip(c)}, '')", STORE_NAMES)


def std_status(c: str = "status") -> str:
    return lookup(f"coalesce({strip(c)}, '')", STATUS_LABELS)


def logistics(loja: str, raw: str) -> str:
    r = f"coalesce({strip(raw)}, '')"
    parts = [f"WHEN {r} = {_q(v)} THEN {_q(label)}" for v, label in LOGISTICS_TOP_RAW]
    for m in sorted(P.marketplaces, key=lambda m: -m.priority):
        parts.append(f"WHEN starts_with({loja}, {_q(m.prefix)}) THEN {_q(m.logistics_class)}")
    parts += [f"WHEN {r} = {_q(v)} THEN {_q(label)}" for v, label in LOGISTICS_LOW_RAW]
    return f"(CASE {' '.join(parts)} ELSE {_q(LOGISTICS_DEFAULT)} END)"


def recompute_cond(loja: str, qty: str) -> str:
    pre = " OR ".join(f"starts_with({loja}, {_q(p)})" for p in P.recompute_prefixes)
    return f"(({pre}) AND {qty} > 0)"


def clean_cte(name: str, src: str, extra: str = "") -> str:
    """B1-B4 over a typed source CTE (std store first, then rules on it)."""
    return f"""
{name}_s AS (
  SELECT * REPLACE ({std_store('loja')} AS loja, {std_status('status')} AS status,
                    CAST(round(valor_total_produto, 3) AS {D3}) AS valor_total_produto,
                    CAST(round(valor_unitario_venda, 3) AS {D3}) AS valor_unitario_venda)
  FROM {src}
),
{name} AS (
  SELECT * REPLACE ({logistics('loja', 'tipo_logistica')} AS tipo_logistica,
                    CASE WHEN {recompute_cond('loja', 'quantidade')}
                         THEN CAST(round(valor_unitario_venda * quantidade, 3) AS {D3})
                         ELSE valor_total_produto END AS valor_total_produto){extra}
  FROM {name}_s
)"""


def parse_dec(t: str, scale: int = 3) -> str:
    return (f"coalesce(CAST(round(TRY_CAST(replace({strip(f'CAST({t} AS VARCHAR)')}, ',', '.') "
            f"AS DECIMAL(38,10)), {scale}) AS DECIMAL(18,{scale})), CAST(0 AS DECIMAL(18,{scale})))")


def parse_long(t: str) -> str:
    return (f"coalesce(TRY_CAST(TRY_CAST(replace({strip(f'CAST({t} AS VARCHAR)')}, ',', '.') "
            f"AS DECIMAL(38,6)) AS BIGINT), 0)")


CLEAN_LINES = SALES_LINES + "," + clean_cte("clean_lines", "sales_lines")

# ---------------------------------------------------------------------------
# Catalogue (A1) and settlement (A2)
# ---------------------------------------------------------------------------

CATALOG = """
cat_rows AS (
  SELECT CAST(l_partkey AS VARCHAR) AS sku, p_name AS titulo_bling,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS estq_txt,
         replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS custo_txt,
         s_name AS Fornecedores, p_type AS Categoria, p_brand AS Subcategoria,
         CASE WHEN l_linestatus = 'F' THEN 'Atacado' END AS tipo_de_venda,
         l_orderkey, l_shipdate, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
),
cat AS (
  SELECT sku,
         CAST(round(max(custo), 3) AS DECIMAL(18,3)) AS custo_unitario,
         CAST(sum(estq) AS BIGINT) AS Estq,
         coalesce(STRIP(first(titulo_bling ORDER BY LO) FILTER (WHERE titulo_bling IS NOT NULL)), '') AS titulo_bling,
         STRIP(first(Fornecedores ORDER BY LO) FILTER (WHERE Fornecedores IS NOT NULL)) AS Fornecedores,
         STRIP(first(Categoria ORDER BY LO) FILTER (WHERE Categoria IS NOT NULL)) AS Categoria,
         STRIP(first(Subcategoria ORDER BY LO) FILTER (WHERE Subcategoria IS NOT NULL)) AS Subcategoria,
         STRIP(first(tipo_de_venda ORDER BY LO) FILTER (WHERE tipo_de_venda IS NOT NULL)) AS tipo_de_venda
  FROM (SELECT * REPLACE (STRIP(sku) AS sku), PARSE_COST AS custo, PARSE_ESTQ AS estq FROM cat_rows)
  WHERE sku IS NOT NULL AND sku <> ''
  GROUP BY sku
)""".replace("LO", LINE_ORDER).replace("PARSE_COST", parse_dec("custo_txt")).replace(
    "PARSE_ESTQ", parse_long("estq_txt"))


def _expand_strip(sql: str) -> str:
    """STRIP(x) -> trim(x, <whitespace>), respecting nested parentheses."""
    out, i = [], 0
    while True:
        j = sql.find("STRIP(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(strip(_expand_strip(sql[j + 6:k - 1])))
        i = k


CATALOG = _expand_strip(CATALOG)

SETTLEMENT = STORE + """,
srows AS (
  SELECT l_returnflag AS arquivo, CAST(l_orderkey AS VARCHAR) AS id_pedido,
         CAST(CAST(l_tax AS DECIMAL(18,3)) * 1000 AS DECIMAL(18,3)) AS moedas,
         CAST(l_discount AS DECIMAL(18,3)) AS cupom,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,3)) * 0.1, 3) AS DECIMAL(18,3)) AS taxa_comissao,
         CAST(l_tax AS DECIMAL(18,3)) AS taxa_servico,
         CAST(o_totalprice AS DECIMAL(18,3)) AS preco_acordado,
         l_orderkey, l_shipdate, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN store s ON o_custkey = s.c_custkey
  WHERE s.r_name = 'ASIA'
),
sfile AS (
  SELECT arquivo, id_pedido,
         CAST(round(sum(CAST(round(moedas * 0.01, 3) AS DECIMAL(18,3)) + cupom), 3) AS DECIMAL(18,3)) AS cashback_cupom,
         CAST(round(sum(taxa_comissao + taxa_servico), 3) AS DECIMAL(18,3)) AS "Comissão",
         CAST(round(first(preco_acordado ORDER BY LO), 3) AS DECIMAL(18,3)) AS preco_acordado
  FROM srows GROUP BY arquivo, id_pedido
),
settle AS (
  SELECT id_pedido, preco_acordado, cashback_cupom, "Comissão" FROM (
    SELECT *, row_number() OVER (PARTITION BY id_pedido ORDER BY arquivo DESC) AS rn FROM sfile) WHERE rn = 1
)""".replace("LO", LINE_ORDER)


def interchange(cols: list[tuple[str, str]]) -> str:
    """Final projection: (expr, kind) with kind 'dec', 'date' or ''."""
    out = []
    for name, kind in cols:
        q = f'"{name}"'
        if kind == "dec":
            out.append(f"CAST(CAST({q} AS DECIMAL(18,3)) AS DOUBLE) AS {q}")
        elif kind == "date":
            out.append(f"strftime({q}, '%Y-%m-%d') AS {q}")
        else:
            out.append(q)
    return ", ".join(out)


def cols(spec: str) -> list[tuple[str, str]]:
    """'a, b:dec, c:date' -> [(a,''), (b,'dec'), (c,'date')]"""
    res = []
    for part in spec.split(","):
        part = part.strip()
        name, _, kind = part.partition(":")
        res.append((name, kind))
    return res


ORACLE["status_store_normalise"] = f"""
WITH {SALES_LINES}
SELECT loja AS loja_original, status AS status_original, {std_store('loja')} AS loja,
       {std_status('status')} AS status, count(*) AS linhas
FROM sales_lines GROUP BY ALL"""

ORACLE["logistics_class"] = f"""
WITH {SALES_LINES}
SELECT loja, tipo_logistica AS tipo_logistica_original,
       {logistics(std_store('loja'), 'tipo_logistica')} AS tipo_logistica, count(*) AS linhas
FROM sales_lines GROUP BY ALL"""

ORACLE["line_revenue_rule"] = f"""
WITH {CLEAN_LINES}
SELECT {interchange(cols('numero_pedido, sku, rastreio, loja, quantidade, valor_unitario_venda:dec, valor_total_produto:dec'))}
FROM clean_lines"""

ORACLE["catalog_agg"] = f"""
WITH {CATALOG}
SELECT {interchange(cols('sku, custo_unitario:dec, Estq, titulo_bling, Fornecedores, Categoria, Subcategoria, tipo_de_venda'))}
FROM cat"""

ORACLE["catalog_enrich"] = f"""
WITH prod AS (
  SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name AS Produto, 'UN' AS UN,
         CAST(p_size AS BIGINT) AS Quantidade,
         replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS "Valor unitario"
  FROM part
),
enr AS (
  SELECT {strip('CAST(l_partkey AS VARCHAR)')} AS sku,
         coalesce({strip('s_name')}, '') AS Fornecedores, coalesce({strip('p_type')}, '') AS Categoria,
         coalesce({strip('p_brand')}, '') AS Subcategoria,
         coalesce({strip("CASE WHEN l_linestatus = 'F' THEN 'Atacado' END")}, '') AS tipo_de_venda,
         row_number() OVER (PARTITION BY l_partkey ORDER BY {LINE_ORDER_DESC}) AS rn
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
)
SELECT p.sku, p.Produto, p.UN, p.Quantidade, p."Valor unitario",
       coalesce(e.Fornecedores, '') AS Fornecedores, coalesce(e.Categoria, '') AS Categoria,
       coalesce(e.Subcategoria, '') AS Subcategoria, coalesce(e.tipo_de_venda, '') AS tipo_de_venda
FROM prod p LEFT JOIN (SELECT * FROM enr WHERE rn = 1) e ON p.sku = e.sku"""

ORACLE["product_flatten"] = """
SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name AS Produto, 'UN' AS UN,
       CAST(p_size AS BIGINT) AS Quantidade,
       replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS "Valor unitario"
FROM part"""


def cost_join(src: str) -> str:
    """J1/J2/B5 over a cleaned source CTE ``src``."""
    fill = ", ".join(f"coalesce({strip(f'c.{c}')}, '') AS {c}"
                     for c in ["Fornecedores", "Categoria", "Subcategoria", "tipo_de_venda"])
    return f"""
{src}_cost AS (
  SELECT s.* EXCLUDE (sku), {strip('s.sku')} AS sku,
         CAST(round(coalesce(c.custo_unitario, 0), 2) AS {D3}) AS custo_unitario,
         coalesce(c.Estq, 0) AS Estq,
         coalesce(s.titulo, c.titulo_bling) AS titulo_final,
         {fill}
  FROM {src} s LEFT JOIN cat c ON {strip('s.sku')} = c.sku
),
{src}_enriched AS (
  SELECT * EXCLUDE (titulo, titulo_final), titulo_final AS titulo,
         CAST(round(quantidade * custo_unitario, 3) AS {D3}) AS custo_total_produto
  FROM {src}_cost
)"""


ORACLE["sales_with_cost"] = f"""
WITH {CLEAN_LINES}, {CATALOG}, {cost_join('clean_lines')}
SELECT {interchange(cols('numero_pedido, sku, rastreio, quantidade, titulo, custo_unitario:dec, custo_total_produto:dec, Estq, Fornecedores, Categoria, Subcategoria, tipo_de_venda'))}
FROM clean_lines_enriched"""

ORACLE["settlement_agg"] = f"""
WITH {SETTLEMENT}
SELECT {interchange(cols('id_pedido, preco_acordado:dec, cashback_cupom:dec, Comissão:dec'))} FROM settle"""


def settle_join(src: str, out: str) -> str:
    return f"""
{out} AS (
  SELECT s.* REPLACE (
           CASE WHEN r.id_pedido IS NOT NULL THEN r.preco_acordado
                ELSE CAST(round(s.valor_unitario_venda * s.quantidade, 3) AS {D3}) END AS valor_total_produto),
         coalesce(r.cashback_cupom, CAST(0 AS {D3})) AS cashback_cupom,
         coalesce(r."Comissão", CAST(0 AS {D3})) AS "Comissão"
  FROM {src} s LEFT JOIN settle r ON s.numero_pedido = r.id_pedido
)"""


ORACLE["sales_with_settlement"] = (
    f"WITH {CLEAN_LINES}, " + SETTLEMENT.replace(STORE + ",", "", 1) + f", {settle_join('clean_lines', 'settled')}\n"
    f"SELECT {interchange(cols('numero_pedido, sku, rastreio, loja, quantidade, valor_total_produto:dec, cashback_cupom:dec, Comissão:dec'))} FROM settled")


# ---------------------------------------------------------------------------
# Full run (Entry A): sheets + feed -> clean -> catalogue -> settlement -> keep last
# ---------------------------------------------------------------------------

RAW_STATUS = ("CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'sent' "
              "WHEN 'P' THEN 'custom_p' ELSE o_orderstatus END")
RAW_LOGISTIC = ("CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'fulfillment' WHEN '2' THEN 'self_service' "
                "WHEN '3' THEN 'xd_drop_off' WHEN '4' THEN 'drop_off' ELSE 'other' END")
FEED_TIME = "printf('%02d:%02d:%02d', o_orderkey % 24, o_custkey % 60, (o_orderkey // 24) % 60)"

FEED_LINES = f"""
feed_lines AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS numero_pedido,
         'ERP-' || CAST(o_orderkey AS VARCHAR) AS numero_pedido_erp,
         CAST(o_custkey AS VARCHAR) AS numero_carrinho,
         CAST(o_orderdate AS DATE) AS data_do_pedido,
         {FEED_TIME} AS hora_do_pedido,
         s.loja,
         coalesce(CAST(l_partkey AS VARCHAR), 'N/A') AS sku,
         CAST(0 AS {D3}) AS valor_total_produto,
         CAST(coalesce(CAST(p_retailprice AS DECIMAL(18,2)), 0) AS {D3}) AS valor_unitario_venda,
         coalesce(CAST(l_quantity AS BIGINT), 0) AS quantidade,
         coalesce(p_name, 'N/A') AS titulo,
         coalesce(s.c_mktsegment, '') AS id_canal_marketplace,
         'BR' || CAST(o_orderkey AS VARCHAR) AS rastreio,
         {RAW_STATUS} AS status,
         {RAW_LOGISTIC} AS tipo_logistica,
         l_orderkey, l_shipdate, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus
  FROM orders JOIN store s ON o_custkey = s.c_custkey
       LEFT JOIN (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey) li ON li.l_orderkey = o_orderkey
)"""

UNION_COLS = ("numero_pedido, numero_pedido_erp, numero_carrinho, data_do_pedido, hora_do_pedido, loja, sku, "
              "valor_total_produto, valor_unitario_venda, quantidade, titulo, id_canal_marketplace, rastreio, "
              "status, tipo_logistica, source_rank, origem_dados, " + LINE_ORDER)


def _refresh_window(as_of):
    """The days that the feed re-reads: on the first only that day, else yesterday and today."""
    import datetime as dt
    return (as_of, as_of) if as_of.day == 1 else (as_of - dt.timedelta(days=1), as_of)


SHARED_RUN = f"{SALES_LINES}, {FEED_LINES}, {CATALOG}, {SETTLEMENT.replace(STORE + ',', '', 1)}"


def run_ctes(as_of, prefix: str = "run", shared: bool = True) -> str:
    """CTEs up to ``<prefix>_fact`` for a run on ``as_of`` (a sheet exists for every month)."""
    body = _run_body(as_of)
    if prefix != "run":
        body = body.replace("run_", prefix + "_")
    return (SHARED_RUN + ",\n" if shared else "") + body


def _run_body(as_of) -> str:
    lo, hi = _refresh_window(as_of)
    key = as_of.strftime("%Y-%m")
    month = "strftime(data_do_pedido, '%Y-%m')"
    sheet_sel = (f"SELECT numero_pedido, numero_pedido_erp, numero_carrinho, data_do_pedido, '' AS hora_do_pedido, "
                 f"loja, sku, valor_total_produto, valor_unitario_venda, quantidade, titulo, id_canal_marketplace, "
                 f"rastreio, status, tipo_logistica, RANK AS source_rank, 'Excel' AS origem_dados, {LINE_ORDER} "
                 f"FROM sales_lines")
    parts = [sheet_sel.replace("RANK", "0") + f" WHERE {month} <> '{key}'"]
    if as_of.day != 1:
        parts.append(sheet_sel.replace("RANK", "1") +
                     f" WHERE {month} = '{key}' AND (data_do_pedido < DATE '{lo}' OR data_do_pedido > DATE '{hi}')")
    parts.append(f"SELECT {UNION_COLS.replace('source_rank, origem_dados', '2 AS source_rank, ' + chr(39) + 'Feed' + chr(39) + ' AS origem_dados')} "
                 f"FROM feed_lines WHERE data_do_pedido BETWEEN DATE '{lo}' AND DATE '{hi}'")
    union = "\nUNION ALL\n".join(parts)
    def m2(c: str) -> str:
        return f'CAST(round("{c}", 2) AS DECIMAL(18,2)) AS "{c}"'

    return f"""run_union AS (
{union}
),
{clean_cte('run_clean', 'run_union')},
{cost_join('run_clean')},
{settle_join('run_clean_enriched', 'run_settled')},
run_dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY numero_pedido, sku
                                 ORDER BY source_rank DESC, {LINE_ORDER_DESC}) AS rn
    FROM (SELECT * REPLACE (coalesce({strip('numero_pedido')}, '') AS numero_pedido,
                            coalesce({strip('sku')}, '') AS sku) FROM run_settled)
  ) WHERE rn = 1
),
run_fact AS (
  SELECT numero_pedido, numero_pedido_erp, numero_carrinho, data_do_pedido, hora_do_pedido, loja, sku,
         {m2('valor_total_produto')}, quantidade, titulo, id_canal_marketplace, rastreio, status, tipo_logistica,
         {m2('custo_unitario')}, {m2('custo_total_produto')}, {m2('Comissão')},
         coalesce({strip('Fornecedores')}, '') AS Fornecedores, Estq,
         coalesce({strip('Categoria')}, '') AS Categoria, coalesce({strip('Subcategoria')}, '') AS Subcategoria,
         coalesce({strip('tipo_de_venda')}, '') AS tipo_de_venda
  FROM run_dedup
)"""


FACT_SPEC = ("numero_pedido, numero_pedido_erp, numero_carrinho, data_do_pedido:date, hora_do_pedido, loja, sku, "
             "valor_total_produto:dec, quantidade, titulo, id_canal_marketplace, rastreio, status, tipo_logistica, "
             "custo_unitario:dec, custo_total_produto:dec, Comissão:dec, Fornecedores, Estq, Categoria, "
             "Subcategoria, tipo_de_venda")


def _as_of(day: int):
    import datetime as dt
    return dt.date(1998, 3, day)


AS_OF, AS_OF_DAY1 = _as_of(15), _as_of(1)
UNION_SPEC = ("numero_pedido, sku, data_do_pedido:date, hora_do_pedido, loja, quantidade, rastreio, source_rank, "
              "origem_dados")

ORACLE["rolling_refresh"] = f"WITH {run_ctes(AS_OF)}\nSELECT {interchange(cols(UNION_SPEC))} FROM run_union"
ORACLE["rolling_refresh_day1"] = f"WITH {run_ctes(AS_OF_DAY1)}\nSELECT {interchange(cols(UNION_SPEC))} FROM run_union"
ORACLE["dedup_last"] = (f"WITH {run_ctes(AS_OF)}\nSELECT {interchange(cols('numero_pedido, sku, data_do_pedido:date, hora_do_pedido, rastreio, source_rank, origem_dados, valor_total_produto:dec'))} FROM run_dedup")
ORACLE["sales_fact"] = f"WITH {run_ctes(AS_OF)}\nSELECT {interchange(cols(FACT_SPEC))} FROM run_fact"
ORACLE["month_slice"] = (
    f"WITH {run_ctes(AS_OF)}\nSELECT {interchange(cols('numero_pedido, sku, data_do_pedido:date, hora_do_pedido, rastreio, quantidade, custo_unitario:dec, custo_total_produto:dec, source_rank'))} "
    f"FROM run_clean_enriched WHERE data_do_pedido >= DATE '1998-03-01' AND data_do_pedido < DATE '1998-04-01'")
ORACLE["pareto_from_fact"] = pareto_sql(run_ctes(AS_OF), "run_fact") + pareto_select()


# ---------------------------------------------------------------------------
# Sources and scalar functions
# ---------------------------------------------------------------------------

ORACLE["order_items_flatten"] = f"""
WITH {STORE}, {FEED_LINES}
SELECT {interchange(cols('numero_pedido, data_do_pedido:date, hora_do_pedido, loja, sku, status, valor_unitario_venda:dec, quantidade, numero_pedido_erp, numero_carrinho, titulo, id_canal_marketplace, rastreio, tipo_logistica'))}
FROM feed_lines"""

ORACLE["order_sample"] = f"""
WITH {STORE}, {FEED_LINES},
first_orders AS (
  SELECT o_orderkey FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-15'
  ORDER BY strftime(o_orderdate, '%Y-%m-%d') || 'T' || {FEED_TIME} || '.000-03:00', CAST(o_orderkey AS VARCHAR)
  LIMIT 10
)
SELECT {interchange(cols('numero_pedido, data_do_pedido:date, hora_do_pedido, loja, status, numero_pedido_erp, id_canal_marketplace, rastreio, tipo_logistica, numero_carrinho, sku, titulo, valor_unitario_venda:dec, quantidade'))}
FROM feed_lines WHERE numero_pedido IN (SELECT CAST(o_orderkey AS VARCHAR) FROM first_orders)"""

ORACLE["page_completeness"] = """
WITH t AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS dia, count(*) AS total FROM orders GROUP BY ALL)
SELECT dia, CAST(total AS BIGINT) AS total, CAST(50 AS BIGINT) AS tamanho_pagina,
       CAST(ceil(total / 50.0) AS BIGINT) AS paginas_esperadas, CAST(ceil(total / 50.0) AS BIGINT) AS paginas_recebidas,
       CAST(0 AS BIGINT) AS paginas_faltantes, CAST(total AS BIGINT) AS pedidos_recebidos, true AS completo
FROM t"""

ORACLE["store_prefix_filter"] = f"""
WITH {SALES_LINES},
g AS (SELECT unnest({group_list('loja')}) AS grupo, quantidade, valor_total_produto FROM sales_lines)
SELECT grupo, count(*) AS linhas, CAST(sum(quantidade) AS BIGINT) AS quantidade,
       CAST(CAST(sum(valor_total_produto) AS DECIMAL(18,3)) AS DOUBLE) AS valor_total_produto
FROM g GROUP BY grupo"""

ORACLE["safe_decimal_parse"] = f"""
WITH t AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS numero_pedido, CAST(l_linenumber AS BIGINT) AS linha,
         replace(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',') AS t_virgula,
         CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 10000 AS DECIMAL(20,2)) AS VARCHAR) AS t_grande,
         l_returnflag AS t_lixo,
         CASE WHEN l_linenumber <> 1 THEN CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) END AS t_nulo,
         CAST(l_quantity AS VARCHAR) AS t_qtd
  FROM lineitem
),
p AS (
  SELECT numero_pedido, linha, {parse_dec('t_virgula')} AS v_virgula, {parse_dec('t_grande')} AS v_grande,
         {parse_dec('t_lixo')} AS v_lixo, {parse_dec('t_nulo', 2)} AS v_nulo, {parse_long('t_qtd')} AS v_qtd
  FROM t
)
SELECT numero_pedido, linha, CAST(v_virgula AS DOUBLE) AS v_virgula, CAST(v_grande AS DOUBLE) AS v_grande,
       CAST(v_lixo AS DOUBLE) AS v_lixo, CAST(v_nulo AS DOUBLE) AS v_nulo, v_qtd FROM p"""


def _sheet_date(t: str) -> str:
    tt = f"replace({strip(t)}, 'T', ' ')"
    head = f"split_part({tt}, ' ', 1)"
    return (f"CASE WHEN contains({head}, '/') THEN CAST(try_strptime({head}, '%d/%m/%Y') AS DATE) "
            f"WHEN contains({head}, '-') THEN CAST(try_strptime({head}, '%Y-%m-%d') AS DATE) END")


ORACLE["date_parse"] = f"""
WITH t AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS numero_pedido,
         CASE substr(o_orderpriority, 1, 1)
              WHEN '1' THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S')
              WHEN '2' THEN strftime(o_orderdate, '%d/%m/%Y')
              WHEN '3' THEN strftime(o_orderdate, '%Y-%m-%d')
              WHEN '4' THEN CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T10:05:00'
                                 WHEN 1 THEN CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR) || ' 9:30'
                                 WHEN 2 THEN chr(160) || strftime(o_orderdate, '%Y-%m-%d') || ' 23:59:59.123' || chr(8195)
                                 ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T23:30:00.000-03:00' END
              ELSE 'x' || CAST(o_orderkey AS VARCHAR) END AS texto
  FROM orders
),
p AS (SELECT numero_pedido, texto, {_sheet_date('texto')} AS data FROM t)
SELECT numero_pedido, texto, strftime(data, '%Y-%m-%d') AS data,
       strftime(data - INTERVAL 1 DAY, '%Y-%m-%d') AS dia_anterior,
       strftime(date_trunc('month', data), '%Y-%m-%d') AS inicio_mes,
       strftime(last_day(data), '%Y-%m-%d') AS fim_mes,
       CAST(month(data) AS BIGINT) AS mes, CAST(year(data) AS BIGINT) AS ano,
       CASE WHEN data IS NULL THEN NULL ELSE {month_label('data')} END AS mes_referencia
FROM p"""


def md_cell(c: str) -> str:
    return f"replace(replace(replace({c}, chr(10), ' '), chr(13), ' '), '|', '-')"


ORACLE["markdown_rows"] = f"""
SELECT doc_id, {md_cell('text')} AS texto_limpo,
       '| ' || concat_ws(' | ', CAST(doc_id AS VARCHAR), coalesce({md_cell('lang')}, ''),
                          coalesce({md_cell('source')}, ''), coalesce({md_cell('text')}, '')) || ' |' AS linha
FROM documents"""


# ---------------------------------------------------------------------------
# File round trips and sinks
# ---------------------------------------------------------------------------

ORACLE["sheet_union"] = f"""
WITH {CLEAN_LINES}
SELECT {interchange(cols('numero_pedido, sku, data_do_pedido:date, loja, valor_total_produto:dec, valor_unitario_venda:dec, quantidade, titulo, status, tipo_logistica, mes, origem_dados'))}
FROM (SELECT *, strftime(data_do_pedido, '%Y-%m') AS mes, 'Excel' AS origem_dados FROM clean_lines)
WHERE mes <> '1998-03'"""

ORACLE["sheet_union_uneven"] = f"""
WITH {CLEAN_LINES}
SELECT {interchange(cols('numero_pedido, numero_pedido_erp, sku, data_do_pedido:date, loja, valor_total_produto:dec, valor_unitario_venda:dec, quantidade, titulo, status, tipo_logistica, mes, rastreio'))}
FROM (SELECT * REPLACE (CASE WHEN month(data_do_pedido) % 3 = 1 THEN titulo || chr(10) || 'linha "2", fim' ELSE titulo END AS titulo,
                        CASE WHEN month(data_do_pedido) % 3 = 2 THEN '' ELSE numero_pedido_erp END AS numero_pedido_erp),
             strftime(data_do_pedido, '%Y-%m') AS mes FROM clean_lines)
WHERE mes <> '1998-03'"""

ORACLE["sheet_missing_headers"] = f"""
WITH {SALES_LINES}
SELECT DISTINCT strftime(data_do_pedido, '%Y-%m') AS mes, h.coluna
FROM sales_lines CROSS JOIN (VALUES {", ".join(f"({_q(k)}, {_q(v)})" for k, v in config.SHEET_HEADERS.items())}) AS h(coluna, nome)
WHERE h.nome NOT IN ('numero_pedido', 'numero_pedido_erp', 'numero_carrinho', 'loja', 'sku', 'id_canal_marketplace', 'rastreio', 'status',
                     'tipo_logistica', 'titulo', 'data_do_pedido', 'valor_total_produto', 'valor_unitario_venda', 'quantidade')
   OR (month(data_do_pedido) % 3 = 2 AND h.nome = 'numero_pedido_erp')"""

ORACLE["catalog_sheet"] = ORACLE["catalog_agg"]
ORACLE["settlement_files"] = ORACLE["settlement_agg"]
# Archive R has no coupon; prices of an order are equal in all its lines, so the line order within a member is immaterial.
ORACLE["settlement_files_uneven"] = ORACLE["settlement_agg"].replace("CAST(l_discount AS DECIMAL(18,3)) AS cupom", "CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_discount AS DECIMAL(18,3)) END AS cupom")
ORACLE["markdown_roundtrip"] = ORACLE["sales_fact"]
ORACLE["fact_full_replace"] = ORACLE["sales_fact"]
ORACLE["fact_publish_recovery"] = ORACLE["sales_fact"]
ORACLE["feed_rejects"] = """
WITH placed AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS dia, CAST(strftime(o_orderdate, '%d') AS INT) AS d, o_orderkey,
    (row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1) // 50 AS pg
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), items AS (
  SELECT dia, count(*) AS n FROM placed JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE pg = 0 AND d % 5 = 0 AND d % 7 <> 0 GROUP BY dia
)
SELECT dia, count(DISTINCT pg) - (CASE WHEN any_value(d) % 7 = 0 THEN 1 ELSE 0 END) AS paginas_recebidas,
  CAST(CASE WHEN any_value(d) % 7 = 0 THEN 1 ELSE 0 END AS BIGINT) AS paginas_ilegiveis, coalesce(any_value(items.n), 0) AS quantidades_nulas
FROM placed LEFT JOIN items USING (dia) GROUP BY dia"""

ORACLE["month_replace"] = f"""
WITH {run_ctes(AS_OF)}, {run_ctes(_as_of(31), prefix='rerun', shared=False)},
merged AS (
  SELECT * FROM run_fact WHERE NOT (data_do_pedido >= DATE '1998-03-01' AND data_do_pedido < DATE '1998-04-01')
  UNION ALL
  SELECT * FROM rerun_fact WHERE data_do_pedido >= DATE '1998-03-01' AND data_do_pedido < DATE '1998-04-01'
)
SELECT {interchange(cols(FACT_SPEC))} FROM merged"""

ORACLE["load_quality"] = f"""
WITH {run_ctes(AS_OF)}
SELECT * FROM (VALUES
  ('fontes_planilhas_fechadas', (SELECT count(*) FROM run_union WHERE source_rank = 0)),
  ('planilha_mes_carregada', (SELECT count(*) FROM sales_lines WHERE strftime(data_do_pedido, '%Y-%m') = '1998-03')),
  ('planilha_mes_mantida', (SELECT count(*) FROM run_union WHERE source_rank = 1)),
  ('feed_janela', (SELECT count(*) FROM run_union WHERE source_rank = 2)),
  ('uniao', (SELECT count(*) FROM run_union)),
  ('datas_nulas', (SELECT count(*) FROM run_union WHERE data_do_pedido IS NULL)),
  ('sem_catalogo', (SELECT count(*) FROM run_clean_enriched e WHERE NOT EXISTS (SELECT 1 FROM cat c WHERE c.sku = e.sku))),
  ('liquidados', (SELECT count(*) FROM run_settled s WHERE EXISTS (SELECT 1 FROM settle r WHERE r.id_pedido = s.numero_pedido))),
  ('fato', (SELECT count(*) FROM run_fact)),
  ('duplicatas_removidas', (SELECT count(*) FROM run_settled) - (SELECT count(*) FROM run_fact)),
  ('colunas_obrigatorias_faltantes', 0)
) AS t(etapa, linhas)"""

# ---------------------------------------------------------------------------
# Jobs from landed files to sinks
# ---------------------------------------------------------------------------

ORACLE["pareto_replace"] = ORACLE["pareto_table_text"]
ORACLE["month_export"] = ORACLE["month_slice"]
ORACLE["pareto_from_markdown"] = ORACLE["pareto_from_fact"]
ORACLE["catalog_refresh"] = ORACLE["catalog_agg"]
ORACLE["sales_job_fact"] = ORACLE["sales_fact"]


def _table_rows(source_cte: str, source: str) -> str:
    return ORACLE["pareto_table_text"].replace(pareto_sql(SALES_LINES, "sales_lines"), pareto_sql(source_cte, source))


ORACLE["pareto_months_replace"] = f"""
SELECT * FROM ({_table_rows(run_ctes(AS_OF), 'run_fact')}) WHERE mes <> '1998-03'
UNION ALL
SELECT * FROM ({_table_rows(run_ctes(_as_of(31)), 'run_fact')}) WHERE mes = '1998-03'"""

ORACLE["fact_incremental_refresh"] = ORACLE["sales_fact"]
ORACLE["pareto_incremental"] = _table_rows(run_ctes(AS_OF), "run_fact")
ORACLE["pareto_from_partials"] = ORACLE["pareto_from_fact"]
ORACLE["job_report"] = ORACLE["load_quality"]

ORACLE["rolling_refresh_no_sheet"] = f"""
WITH {SALES_LINES}, {FEED_LINES},
run_union AS (
  SELECT numero_pedido, sku, data_do_pedido, '' AS hora_do_pedido, loja, quantidade, rastreio, 0 AS source_rank, 'Excel' AS origem_dados
  FROM sales_lines WHERE strftime(data_do_pedido, '%Y-%m') <> '1998-03'
  UNION ALL
  SELECT numero_pedido, sku, data_do_pedido, hora_do_pedido, loja, quantidade, rastreio, 2, 'Feed'
  FROM feed_lines WHERE data_do_pedido BETWEEN DATE '1998-03-01' AND DATE '1998-03-15'
)
SELECT {interchange(cols(UNION_SPEC))} FROM run_union"""

ORACLE["sheet_unreadable"] = """
SELECT 'data_do_pedido' AS coluna, count(*) AS preenchidos, count(*) FILTER (o_orderkey % 3 = 0) AS ilegiveis FROM orders
UNION ALL
SELECT 'valor_total_produto', count(*) FILTER (o_orderkey % 5 <> 0), count(*) FILTER (o_orderkey % 5 <> 0 AND o_orderkey % 7 = 0) FROM orders
UNION ALL
SELECT 'quantidade', count(*) FILTER (o_orderkey % 2 <> 0), 0 FROM orders"""

ORACLE["sales_settlement_allocated"] = f"""
WITH {CLEAN_LINES}, {SETTLEMENT.replace(STORE + ',', '', 1)},
j AS (
  SELECT c.numero_pedido, c.sku, c.rastreio, s.id_pedido, s.preco_acordado AS p,
         CAST(round(c.valor_unitario_venda * c.quantidade, 3) AS {D3}) AS v
  FROM clean_lines c LEFT JOIN settle s ON c.numero_pedido = s.id_pedido
),
w AS (
  SELECT *, CAST(p * 1000 AS HUGEINT) AS pm, CAST(greatest(v, 0) * 1000 AS HUGEINT) AS vm,
         CAST(sum(greatest(v, 0)) OVER (PARTITION BY numero_pedido) * 1000 AS HUGEINT) AS tm,
         CAST(sum(greatest(v, 0)) OVER (PARTITION BY numero_pedido ORDER BY sku, rastreio ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 1000 AS HUGEINT) AS cm
  FROM j
)
SELECT numero_pedido, sku, rastreio,
       CAST(CASE WHEN id_pedido IS NULL THEN v
                 ELSE CAST((2 * pm * cm + tm) // (2 * tm) - (2 * pm * (cm - vm) + tm) // (2 * tm) AS DECIMAL(18,0)) * 0.001 END AS DOUBLE) AS valor_total_produto
FROM w"""
