"""The same results in plain SQL, for checking on another engine."""

from __future__ import annotations

from agrometry.plans.inputs import DEW_MAX, HUMIDITY, PRESSURE, RADIATION, RAIN, TEMPERATURE, TEMPERATURE_MAX, TEMPERATURE_MIN, WIND

MEASURES = (
    "precipitacao_mm", "temperatura_c", "temp_max_c", "temp_min_c",
    "umidade_pct", "pressao_mb", "radiacao_kj_m2", "vento_velocidade_ms",
)

HOURLY = """
hourly as (
  select 'A' || lpad(cast(l_suppkey as varchar), 9, '0') as estacao_codigo,
         s_name as estacao_nome,
         'U' || lpad(cast(s_nationkey as varchar), 2, '0') as uf,
         case when l_orderkey % 97 <> 0 then cast(l_shipdate as date) end as data,
         lpad(cast(l_linenumber as varchar), 2, '0') || '00 UTC' as hora_utc,
         case when l_suppkey % 10 = 3 or l_returnflag = 'R' then null
              when l_linenumber = 1 then 0.0::double
              else (cast(round(l_extendedprice * 100) as bigint) * (l_suppkey % 10) // 100)::double / 10000 end as precipitacao_mm,
         case when not (l_linenumber = 6 and l_tax = 0)
              then 10 + l_quantity * 0.5 + case when l_linenumber = 7 then 40 else 0 end end as temperatura_c,
         10 + l_quantity * 0.5 + l_tax * 20 as temp_max_c,
         10 + l_quantity * 0.5 - l_discount * 20 as temp_min_c,
         l_discount * 1000 as umidade_pct,
         900 + l_quantity as pressao_mb,
         round(l_extendedprice * 100) / 10000 as radiacao_kj_m2,
         l_tax * 100 as vento_velocidade_ms
  from (select * from lineitem union all select * from lineitem where l_returnflag = 'A') l
  join supplier on l_suppkey = s_suppkey
)"""

RAW_WEATHER = f"""
raw_weather as (
  select case when l_orderkey % 97 = 0 then null
              when l_orderkey % 89 = 0 then 'nan'
              else strftime(l_shipdate, '%Y/%m/%d') end as "Data",
         lpad(cast((l_orderkey * 7 + l_linenumber) % 24 as varchar), 2, '0') || '00 UTC' as "Hora UTC",
         replace(cast(cast(l_tax * 100 as decimal(10,1)) as varchar), '.', ',') as "{RAIN}",
         case l_linenumber when 7 then '' when 6 then ' ' when 5 then ',' when 4 then 'nan'
              when 3 then cast(cast(10 + l_quantity * 0.5 as decimal(10,1)) as varchar)
              else replace(cast(cast(10 + l_quantity * 0.5 as decimal(10,1)) as varchar), '.', ',') end as "{TEMPERATURE}",
         cast(cast(10 + l_quantity * 0.5 + l_tax * 500 as decimal(10,1)) as varchar) as "{TEMPERATURE_MAX}",
         cast(cast(5 + l_quantity * 0.5 as decimal(10,1)) as varchar) as "{DEW_MAX}",
         cast(cast(round(l_discount * 1000) + case when l_quantity = 50 and l_linenumber = 1 then 50 else 0 end as int) as varchar) as "{HUMIDITY}",
         cast(cast(10 + l_quantity * 0.5 - l_discount * 100 as decimal(10,1)) as varchar) as "{TEMPERATURE_MIN}",
         replace(cast(cast(900 + l_quantity as decimal(10,1)) as varchar), '.', ',') as "{PRESSURE}",
         case when l_linenumber <> 2 then cast(cast(floor(l_extendedprice) as bigint) as varchar) end as "{RADIATION}",
         replace(cast(cast(l_tax * 100 as decimal(10,1)) as varchar), '.', ',') as "{WIND}",
         'file:/raw/' || year(l_shipdate) || '/INMET_SE_'
           || chr(cast(65 + l_suppkey % 26 as int)) || chr(cast(65 + l_suppkey // 26 % 26 as int))
           || '_A' || lpad(cast(l_suppkey as varchar), 9, '0')
           || '_SERRA ' || lpad(cast(l_suppkey as varchar), 9, '0') || ' - SUL_01-01-'
           || year(l_shipdate) || '_A_31-12-' || year(l_shipdate) || '.parquet' as arquivo_origem
  from lineitem
)"""

CROPS = """
sized as (
  select p_name as cultura, min(p_type) as categoria, sum(p_size) % 50 as tamanho, sum(p_partkey) as chaves
  from part group by p_name
),
crops as (
  select cultura, categoria,
         (8 + tamanho % 14) || '-' || (22 + tamanho % 16) || '°C' as clima_ideal,
         cast(case when tamanho % 11 <> 0 then 8 + tamanho % 14 end as int) as temp_min_ideal,
         cast(case when tamanho % 11 <> 0 then 22 + tamanho % 16 end as int) as temp_max_ideal,
         case chaves % 4 when 0 then 'Alta' when 1 then 'Média' when 2 then 'Baixa' else 'Variável' end as necessidade_de_agua,
         case chaves % 4 when 0 then 3 when 2 then 1 else 2 end as necessidade_agua_score,
         chaves % 5 = 0 as tolerante_seca,
         chaves % 7 = 0 as tolerante_frio,
         tamanho % 4 = 0 as sensivel_frio,
         chaves % 6 = 0 as sensivel_calor
  from sized
)"""

RAW_CROPS = """
raw_crops as (
  select 'C' || lpad(cast(p_partkey as varchar), 9, '0') || ' ' || p_name as cultura,
         p_type as categoria,
         case when p_size % 11 = 0 then 'pleno sol'
              else (8 + p_size % 14) || '-' || (22 + p_size % 16) || '°C; pleno sol' end as clima_ideal,
         case p_size % 4 when 0 then 'Alta' when 1 then 'Média' when 2 then 'Baixa' else 'Variável' end as necessidade_de_agua,
         case p_size % 7 when 0 then 'Tolerante à seca' when 1 then 'Resistente ao frio'
              when 2 then 'Sensível ao frio' when 3 then 'Sensível ao calor'
              when 4 then 'Tolerante ao frio; sensível à seca' when 5 then 'Rústica' end as observacoes_praticas
  from part
)"""

FARMS = """
farms as (
  select o_custkey - 20 as "AREA_HECTARE",
         case when o_orderpriority like '5%' then -o_totalprice else o_totalprice end as "Producao_t",
         year(o_orderdate) - case when o_orderstatus = 'P' then 200 else 0 end as "Ano",
         case when o_orderkey % 13 = 0 then 'sem dado' else cast(o_custkey - 5 as varchar) end as qtd_sacas
  from orders
)"""

SOILS = """
soils as (
  select p_partkey as "AMOSTRA", p_size / 3.0 as "PH_agua", p_size * 11 as profundidade_cm, p_size * 2.5 - 5 as argila
  from part
)"""


def _units(c: str) -> str:
    """A value in whole units of 10**-12, from its decimals."""
    return f"cast(replace(cast(cast({c} as decimal(38,12)) as varchar), '.', '') as hugeint)"


def _half_up(units: str, count: str, places: int) -> str:
    """Units divided by a count and rounded once, in whole numbers; written as text, as a double shows it."""
    steps = f"(abs({units}) * {2 * 10**places} + {count} * {10**12}::hugeint) // ({2 * 10**12}::hugeint * {count})"
    return f"cast(sign({units}) * cast({steps} as double) / {10**places} as double)"


def _mean(c: str) -> str:
    return _half_up(f"sum({_units(c)})", f"nullif(count({c}), 0)", 1)


def _total(c: str, places: int = 1) -> str:
    return _half_up(f"sum({_units(c)})", "1", places)


def _low(c: str) -> str:
    return _half_up(f"min({_units(c)})", "1", 1)


def _high(c: str) -> str:
    return _half_up(f"max({_units(c)})", "1", 1)


def _season(month: str, summer: str) -> str:
    return (
        f"case when {month} in (12, 1, 2) then '{summer}' when {month} in (3, 4, 5) then 'Outono' "
        f"when {month} in (6, 7, 8) then 'Inverno' else 'Primavera' end"
    )


DATED = "dated as (select * from hourly where data is not null)"

STAGED = f"""
staged as (
  select distinct estacao_codigo, estacao_nome, uf, data, hora_utc,
         cast(year(data) as int) as ano, cast(month(data) as int) as mes,
         {", ".join(MEASURES)}
  from hourly
  where data is not null and (temperatura_c is null or temperatura_c between -40 and 60)
)"""

MONTHLY_W = f"""
mensal_w as (
  select estacao_codigo, estacao_nome, uf, ano, mes,
         {_mean("temperatura_c")} as temp_media_c, {_high("temp_max_c")} as temp_max_c,
         {_low("temp_min_c")} as temp_min_c, {_mean("temp_max_c")} as temp_max_media_c,
         {_mean("temp_min_c")} as temp_min_media_c, {_total("precipitacao_mm")} as precipitacao_total_mm,
         count(case when precipitacao_mm > 0 then 1 end) as dias_com_chuva,
         {_mean("umidade_pct")} as umidade_media_pct, {_low("umidade_pct")} as umidade_min_pct,
         {_mean("vento_velocidade_ms")} as vento_medio_ms, count(*) as total_medicoes
  from staged group by all
)"""

SEASONAL_W = f"""
sazonal_w as (
  select estacao_codigo, estacao_nome, uf, ano, {_season("mes", "Verao")} as estacao_ano,
         {_mean("temp_media_c")} as temp_media_c, {_high("temp_max_c")} as temp_max_c,
         {_low("temp_min_c")} as temp_min_c, {_mean("temp_max_media_c")} as temp_max_media_c,
         {_mean("temp_min_media_c")} as temp_min_media_c,
         {_total("precipitacao_total_mm")} as precipitacao_total_mm,
         cast(sum(dias_com_chuva) as bigint) as dias_com_chuva,
         {_mean("umidade_media_pct")} as umidade_media_pct, {_low("umidade_min_pct")} as umidade_min_pct,
         count(*) as meses_no_periodo
  from mensal_w group by all
)"""

# Drought is worked out in whole 10^-21 units, with the rain share kept to 20
# digits; cold, heat and the class use exact tenths.
MART = """
pares as (
  select s.*, c.* from sazonal_w s cross join crops c
),
riscos as (
  select *,
    cast((greatest(0, least(10000000000000000000000,
        (100000000000000000000
           - (cast(round(precipitacao_total_mm * 10) as hugeint) * 200000000000000000000 + 3000) // 6000)
        * necessidade_agua_score * case when tolerante_seca then 7 else 10 end)) * 10
      + 50000000000000000000) // 100000000000000000000 as double) / 10 as risco_seca,
    cast(case when tolerante_frio or temp_min_ideal is null then 0
         when temp_min_c < temp_min_ideal then round(least(10,
           (temp_min_ideal - cast(temp_min_c as decimal(9,1))) * case when sensivel_frio then 1.5 else 1.0 end), 1)
         else 0 end as double) as risco_frio,
    cast(case when temp_max_ideal is null then 0
         when temp_max_c > temp_max_ideal then round(least(10,
           (cast(temp_max_c as decimal(9,1)) - temp_max_ideal) * case when sensivel_calor then 1.5 else 1.0 end), 1)
         else 0 end as double) as risco_calor
  from pares
),
decimos as (
  select *, cast(round((risco_seca + risco_frio + risco_calor) * 10) as bigint) as pontos from riscos
),
mart as (
  select estacao_codigo, estacao_nome, uf, ano, estacao_ano, cultura, categoria,
         temp_media_c, temp_max_c, temp_min_c, precipitacao_total_mm, dias_com_chuva, umidade_media_pct,
         temp_min_ideal, temp_max_ideal, necessidade_agua_score,
         tolerante_seca, tolerante_frio, sensivel_frio, sensivel_calor,
         risco_seca, risco_frio, risco_calor,
         (pontos * 2 + 3) // 6 / 10.0::double as risco_total,
         case when pontos < 60 then 'Baixo' when pontos < 135 then 'Medio' when pontos < 210 then 'Alto'
              else 'Critico' end as classificacao_risco
  from decimos
)"""

DAILY = f"""
diario as (
  select data, estacao_codigo, estacao_nome, uf,
         {_mean("temperatura_c")} as temp_media, {_low("temp_min_c")} as temp_min,
         {_high("temp_max_c")} as temp_max, {_total("precipitacao_mm")} as precipitacao_mm,
         {_mean("umidade_pct")} as umidade_media, {_total("radiacao_kj_m2", 0)} as radiacao_total,
         count(*) as qtd_registros
  from dated group by all
)"""

MONTHLY = f"""
mensal as (
  select cast(year(data) as int) as ano, cast(month(data) as int) as mes, estacao_codigo,
         {_mean("temp_media")} as temp_media_mensal, {_low("temp_min")} as temp_min_absoluta,
         {_high("temp_max")} as temp_max_absoluta, {_total("precipitacao_mm")} as precipitacao_total_mm,
         {_mean("umidade_media")} as umidade_media_mensal,
         cast(sum(case when precipitacao_mm > 0 then 1 else 0 end) as bigint) as dias_chuva,
         count(*) as dias_no_mes, {_season("month(data)", "Verão")} as estacao
  from diario group by all
)"""


def _seasonal(name: str, keys: str) -> str:
    return f"""
{name} as (
  select {keys}, {_mean("temp_media_mensal")} as temp_media, {_low("temp_min_absoluta")} as temp_min,
         {_high("temp_max_absoluta")} as temp_max, {_total("precipitacao_total_mm")} as precipitacao_total_mm,
         {_mean("umidade_media_mensal")} as umidade_media, cast(sum(dias_chuva) as bigint) as dias_chuva
  from mensal group by all
)"""


def _fact(name: str, seasonal: str, station: str) -> str:
    gap = "case when temp_media < temp_min_ideal then temp_min_ideal - temp_media else temp_media - temp_max_ideal end"

    def band(values):
        alta, media, baixa = values
        return f"case necessidade_de_agua when 'Alta' then {alta} when 'Baixa' then {baixa} else {media} end"

    low, high, critical = band((200, 100, 30)), band((500, 350, 200)), band((100, 50, 15))
    return f"""
{name}_s as (
  select *,
    case when temp_media is null or temp_min_ideal is null or temp_max_ideal is null then 50
         when temp_media between temp_min_ideal and temp_max_ideal then 95
         when {gap} <= 3 then 70 when {gap} <= 6 then 45 else 20 end as score_temperatura,
    case when precipitacao_total_mm is null or necessidade_de_agua is null then 50
         when precipitacao_total_mm between {low} and {high}
           then case when dias_chuva >= 15 then 95 else 80 end
         when precipitacao_total_mm < {critical} then 15
         when precipitacao_total_mm < {low} then 50
         when precipitacao_total_mm - {high} > 300 then 30
         else 60 end as score_precipitacao
  from {seasonal} cross join crops
),
{name}_r as (
  select *,
    cast((score_temperatura * 6 + score_precipitacao * 4 + 5) // 10 as int) as score_final,
    score_temperatura * 0.6 + score_precipitacao * 0.4
      + case when tolerante_seca and score_precipitacao < 50 then 15 else 0 end
      + case when tolerante_frio and score_temperatura < 60 then 15 else 0 end
      - case when sensivel_frio and score_temperatura < 70 then 20 else 0 end
      - case when sensivel_calor and score_temperatura < 70 then 20 else 0 end as ajustado
  from {name}_s
),
{name} as (
  select cultura, categoria, {station} ano, estacao, temp_media as temp_real, temp_min as temp_min_real,
         temp_max as temp_max_real, precipitacao_total_mm as precipitacao_mm, dias_chuva, umidade_media,
         temp_min_ideal, temp_max_ideal, necessidade_de_agua,
         tolerante_seca, tolerante_frio, sensivel_frio, sensivel_calor,
         score_temperatura, score_precipitacao, score_final,
         case when ajustado >= 80 then 'BAIXO' when ajustado >= 60 then 'MÉDIO'
              when ajustado >= 40 then 'ALTO' else 'CRÍTICO' end as risco_geral,
         case when ajustado >= 80 then '✅ IDEAL PARA PLANTIO' when ajustado >= 60 then '⚠️ POSSÍVEL COM CUIDADOS'
              when ajustado >= 40 then '⚠️ ALTO RISCO - EVITAR' else '❌ NÃO RECOMENDADO' end as recomendacao
  from {name}_r
)"""


SEASONAL = _seasonal("estacional", "ano, estacao")
SEASONAL_STATION = _seasonal("estacional_e", "ano, estacao, estacao_codigo")
LAKE = [HOURLY, DATED, DAILY, MONTHLY]
FACT = [*LAKE, SEASONAL, CROPS, _fact("fato", "estacional", "")]
FACT_STATION = [*LAKE, SEASONAL_STATION, CROPS, _fact("fato_e", "estacional_e", "estacao_codigo,")]
WAREHOUSE = [HOURLY, STAGED, MONTHLY_W, SEASONAL_W]
FULL_MART = [*WAREHOUSE, CROPS, MART]


def _with(parts: list[str], select: str) -> str:
    return f"with {','.join(parts)}\n{select}"


def _ranking(fact: str, ties: str) -> str:
    return f"""
select estacao, cast(ranking as int) as ranking, cultura, categoria, score_final, risco_geral, recomendacao
from (select *, row_number() over (partition by estacao order by score_final desc, {ties}) as ranking from {fact})
where ranking <= 10"""


def _top_crops(risks: str) -> str:
    return f"""
select cultura, categoria, count(*) as count from fato_e where risco_geral in ({risks})
group by all order by count desc, cultura, categoria limit 5"""


# One violated check per row; SQL states each check on its own.
def _dq(rows: list[tuple[str, str | None, str, str, str]], source: str) -> str:
    parts = [
        f"select '{rule}' as rule, {'null' if column is None else repr(column)}::varchar as \"column\", "
        f"'{severity}' as severity, {count} as rows_affected from {source} having {fires}"
        for rule, column, severity, count, fires in rows
    ]
    return "\nunion all ".join(parts)


def _num(column: str) -> str:
    return f"nullif(try_cast(\"{column}\" as double), 'nan'::double)"


def _range(rule: str, column: str, low, high, severity: str = "ERROR"):
    tests = [f"{_num(column)} < {low}"] if low is not None else []
    tests += [f"{_num(column)} > {high}"] if high is not None else []
    count = f"count(*) filter (where {' or '.join(tests)})"
    return rule, column, severity, count, f"{count} > 0"


def _nulls(column: str, severity: str = "ERROR"):
    count = f'count(*) filter (where "{column}" is null)'
    return "not_null", column, severity, count, f"{count} > 0"


NOT_EMPTY = ("not_empty", None, "ERROR", "0::bigint", "count(*) = 0")
DQ_TEMPERATURE = [
    _range("temperatura_valida", c, -15, 50, "WARNING") for c in (TEMPERATURE, TEMPERATURE_MAX, DEW_MAX, TEMPERATURE_MIN)
]
DQ_HUMIDITY = [_range("umidade_valida", HUMIDITY, 0, 100)]
DQ_AREA = [_range("area_valida", "AREA_HECTARE", 0, None)]
DQ_PRODUCTION = [_range("producao_valida", "Producao_t", 0, None)]
DQ_YEAR = [_range("ano_valido", "Ano", 1900, 2100)]
DQ_QUANTITY = [_range("quantidade_valida", "qtd_sacas", 0, None)]
DQ_PH = [_range("ph_valido", "PH_agua", 0, 14)]
DQ_DEPTH = [_range("profundidade_valida", "profundidade_cm", 0, 500, "WARNING")]
DQ_PERCENTAGE = [_range("percentual_valido", c, 0, 100) for c in ("AMOSTRA", "argila")]
DQ_REQUIRED = [("required_columns", None, "ERROR", "count(*)", "true")]
DQ_NOT_NULL = [_nulls("Data"), _nulls("Hora UTC")]

FILE_COUNTS = f"""
por_arquivo as (
  select arquivo_origem, count(*) as linhas,
         count(*) filter (where "Data" is null) as sem_data,
         count(*) filter (where try_cast("{HUMIDITY}" as double) not between 0 and 100) as umidade_ruim
  from raw_weather group by all
)"""


_WEATHER_CELLS = ("Data", "Hora UTC", RAIN, TEMPERATURE, TEMPERATURE_MAX, DEW_MAX, HUMIDITY, TEMPERATURE_MIN, PRESSURE, RADIATION, WIND)
_LINE = "concat_ws(';', " + ", ".join(f"coalesce(\"{c}\", '')" for c in _WEATHER_CELLS) + ")"
_SOUND = f"coalesce(\"Data\" <> 'nan' and cast(\"{HUMIDITY}\" as int) between 0 and 100, false)"

# Files by ten stations and year, with a line of title and a header.
TREE = f"""
lida as (
  select *, cast(regexp_extract(arquivo_origem, '_A([0-9]+)_', 1) as bigint) // 10 as part,
         regexp_extract(arquivo_origem, '/raw/([0-9]+)/', 1) as year, {_SOUND} as boa
  from raw_weather
),
arquivo as (
  select part, year, count(*) as linhas, count(*) filter (where not boa) as ruins,
         sum(strlen({_LINE}) + 1) + strlen('ESTACOES') + strlen('{";".join(_WEATHER_CELLS)}') + 2 as bytes
  from lida where boa or part % 3 = 1 group by part, year
)"""


def _ingested(files: str) -> str:
    return f"""select count(*) as total_arquivos, count(*) filter (where ruins = 0) as arquivos_ingeridos,
      count(*) filter (where ruins > 0) as arquivos_com_erro,
      round(count(*) filter (where ruins = 0) * 100.0::double / count(*), 2) as taxa_sucesso,
      cast(coalesce(sum(case when ruins = 0 then linhas end), 0) as bigint) as linhas_processadas,
      cast(coalesce(sum(case when ruins = 0 then bytes end), 0) as bigint) as bytes_processados
    from {files}"""


def _blank(c: str) -> str:
    return f"""case when isnan(try_cast(replace("{c}", ',', '.') as float)) then null
      else try_cast(replace("{c}", ',', '.') as float) end"""


def sql() -> dict[str, str]:
    lake_day = "try_strptime(\"Data\", '%Y/%m/%d')::date"
    queries = {
        "stg_clima": _with([HOURLY, STAGED], "select * from staged"),
        "stg_culturas": _with([CROPS], "select * from crops where cultura is not null"),
        "int_clima_mensal": _with([HOURLY, STAGED, MONTHLY_W], "select * from mensal_w"),
        "int_clima_sazonal": _with(WAREHOUSE, "select * from sazonal_w"),
        "fct_risco_climatico": _with(FULL_MART, "select * from mart"),
        "top_riscos_mart": _with(
            FULL_MART,
            """select cultura, uf, estacao_ano, risco_total, classificacao_risco from mart
               where classificacao_risco in ('Alto', 'Critico')
               order by risco_total desc, cultura, uf, estacao_codigo, ano, estacao_ano limit 20""",
        ),
        "registros_por_estacao": _with(
            [HOURLY, DATED],
            "select estacao_codigo, estacao_nome, uf, count(*) as registros from dated group by all",
        ),
        "bronze_clima_typed": _with(
            [RAW_WEATHER],
            f"""select {lake_day} as data, "Hora UTC" as hora_utc, {_blank(RAIN)} as precipitacao_mm,
                {_blank(TEMPERATURE)} as temperatura_c, {_blank(TEMPERATURE_MAX)} as temp_max_c,
                {_blank(TEMPERATURE_MIN)} as temp_min_c, {_blank(HUMIDITY)} as umidade_pct,
                {_blank(PRESSURE)} as pressao_mb, {_blank(RADIATION)} as radiacao_kj_m2,
                {_blank(WIND)} as vento_velocidade_ms,
                regexp_extract(arquivo_origem, 'INMET_[A-Z]+_([A-Z][A-Z])_', 1) as uf,
                'A' || substr(split_part(arquivo_origem, '_', 4), 2) as estacao_codigo,
                split_part(arquivo_origem, '_', 5) as estacao_nome, 'bronze' as camada
                from raw_weather where {lake_day} is not null""",
        ),
        "bronze_rename_rules": _with(
            [RAW_WEATHER],
            f"""select "Data" as data, "Hora UTC" as hora_utc, "{RAIN}" as precipitacao_mm,
                "{TEMPERATURE}" as temperatura_c, "{TEMPERATURE_MAX}" as temp_max_c,
                "{TEMPERATURE_MIN}" as temp_min_c, "{HUMIDITY}" as umidade_pct, "{PRESSURE}" as pressao_mb,
                "{RADIATION}" as radiacao_kj_m2, "{WIND}" as vento_velocidade_ms from raw_weather""",
        ),
        "bronze_culturas": _with(
            [RAW_CROPS],
            """select *,
                try_cast(regexp_extract(clima_ideal, '([0-9]+)-[0-9]+', 1) as int) as temp_min_ideal,
                try_cast(regexp_extract(clima_ideal, '[0-9]+-([0-9]+)', 1) as int) as temp_max_ideal,
                case necessidade_de_agua when 'Alta' then 3 when 'Média' then 2 when 'Baixa' then 1 else 2 end
                  as necessidade_agua_score,
                coalesce(lower(observacoes_praticas) like '%tolerante%' and lower(observacoes_praticas) like '%seca%', false) as tolerante_seca,
                coalesce((lower(observacoes_praticas) like '%tolerante%' or lower(observacoes_praticas) like '%resistente%')
                  and lower(observacoes_praticas) like '%frio%', false) as tolerante_frio,
                coalesce(lower(observacoes_praticas) like '%sensível%' and lower(observacoes_praticas) like '%frio%', false) as sensivel_frio,
                coalesce(lower(observacoes_praticas) like '%sensível%' and lower(observacoes_praticas) like '%calor%', false) as sensivel_calor,
                'bronze' as camada
               from raw_crops""",
        ),
        "bronze_union_sources": _with(
            [RAW_CROPS],
            """select cultura, categoria, clima_ideal, necessidade_de_agua, observacoes_praticas,
                 null::varchar as tipo_de_solo, null::varchar as profundidade from raw_crops
               union all select null, null, null, null, null, s_name, cast(s_nationkey as varchar) from supplier""",
        ),
        "station_from_filename": _with(
            [RAW_WEATHER],
            """select arquivo_origem,
                 substr(split_part(arquivo_origem, '_', 3), 1, 2) as uf,
                 split_part(arquivo_origem, '_', 4) as estacao_codigo,
                 split_part(arquivo_origem, '_', 5) as estacao_nome, count(*) as linhas
               from raw_weather group by all""",
        ),
        "clean_counts": _with(
            [RAW_WEATHER],
            f"""select count(*) as registros_antes, count({lake_day}) as registros_depois,
                count(*) - count({lake_day}) as removidos from raw_weather""",
        ),
        "dim_tempo": _with(
            [HOURLY, DATED],
            f"""select distinct data, cast(year(data) as int) as ano, cast(month(data) as int) as mes,
                cast(day(data) as int) as dia, cast(quarter(data) as int) as trimestre,
                {_season("month(data)", "Verão")} as estacao,
                ['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro',
                 'Outubro','Novembro','Dezembro'][month(data)] as nome_mes from dated""",
        ),
        "clima_diario": _with([HOURLY, DATED, DAILY], "select * from diario"),
        "clima_mensal": _with(LAKE, "select * from mensal"),
        "clima_estacional": _with([*LAKE, SEASONAL], "select * from estacional"),
        "season_order": _with(
            [*LAKE, SEASONAL],
            """select case estacao when 'Verão' then 1 when 'Outono' then 2 when 'Inverno' then 3 else 4 end as ordem,
               ano, estacao from estacional""",
        ),
        "silver_culturas": _with(
            [CROPS],
            """select *, (temp_min_ideal + temp_max_ideal) / 2.0::double as temp_media_ideal,
                 case when temp_min_ideal + temp_max_ideal < 30 then 'frio'
                      when temp_min_ideal + temp_max_ideal < 44 then 'ameno'
                      when temp_min_ideal + temp_max_ideal < 56 then 'quente' else 'muito_quente' end as perfil_temperatura,
                 temp_max_ideal - temp_min_ideal as amplitude_termica,
                 case when tolerante_seca then 2 else 0 end + case when tolerante_frio then 2 else 0 end
                   + 4 - necessidade_agua_score as score_rusticidade
               from crops""",
        ),
        "fato_risco_climatico": _with(FACT, "select * from fato"),
        "fato_risco_por_estacao": _with(FACT_STATION, "select * from fato_e"),
        "ranking_culturas": _with(FACT, _ranking("fato", "cultura, ano")),
        "ranking_por_estacao": _with(FACT_STATION, _ranking("fato_e", "cultura, ano, estacao_codigo")),
        "distribuicao_risco": _with(
            FACT_STATION, "select estacao, risco_geral, count(*) as count from fato_e group by all"
        ),
        "resumo_executivo": _with(
            FACT_STATION,
            """select estacao, count(*) as total,
                 count(*) filter (where risco_geral = 'BAIXO') as baixo,
                 count(*) filter (where risco_geral = 'MÉDIO') as medio,
                 count(*) filter (where risco_geral = 'ALTO') as alto,
                 count(*) filter (where risco_geral = 'CRÍTICO') as critico,
                 count(*) filter (where risco_geral = 'BAIXO') * 100.0::double / count(*) as pct_baixo,
                 count(*) filter (where risco_geral = 'MÉDIO') * 100.0::double / count(*) as pct_medio,
                 count(*) filter (where risco_geral = 'ALTO') * 100.0::double / count(*) as pct_alto,
                 count(*) filter (where risco_geral = 'CRÍTICO') * 100.0::double / count(*) as pct_critico
               from fato_e group by estacao""",
        ),
        "top_versateis": _with(FACT_STATION, _top_crops("'BAIXO'")),
        "top_arriscadas": _with(FACT_STATION, _top_crops("'ALTO', 'CRÍTICO'")),
        "score_temperatura": _with(
            FACT_STATION,
            """select cultura, estacao_codigo, ano, estacao, temp_real, temp_min_ideal, temp_max_ideal,
               score_temperatura from fato_e""",
        ),
        "score_precipitacao": _with(
            FACT_STATION,
            """select cultura, estacao_codigo, ano, estacao, precipitacao_mm, necessidade_de_agua, dias_chuva,
               score_precipitacao from fato_e""",
        ),
        "risco_geral": _with(
            FACT_STATION,
            """select cultura, estacao_codigo, ano, estacao, score_temperatura, score_precipitacao, score_final,
               risco_geral from fato_e""",
        ),
        "recomendacao": _with(
            FACT_STATION, "select risco_geral, recomendacao, count(*) as linhas from fato_e group by all"
        ),
        # Data quality
        "dq_not_empty": "\nunion all ".join(
            f"select '{name}' as tabela, * from ({_dq([NOT_EMPTY], f'(select * from supplier where s_suppkey {test} (select l_suppkey from lineitem))')})"
            for name, test in (("sem_leituras", "not in"), ("com_leituras", "in"))
        ),
        "dq_rule_crash": _with(
            [RAW_WEATHER],
            _dq([*DQ_NOT_NULL, ("regra_quebrada", None, "ERROR", "0::bigint", "count(*) filter (where \"Data\" like '%/%') > 0"), *DQ_TEMPERATURE, *DQ_HUMIDITY], "raw_weather"),
        ),
        "dq_validate_file": _with(
            [RAW_WEATHER, f"lines as ({_dq([NOT_EMPTY, *DQ_NOT_NULL, *DQ_TEMPERATURE, *DQ_HUMIDITY], 'raw_weather')})"],
            """select case severity when 'WARNING' then 'warnings' else 'errors' end as tipo, rule, "column", rows_affected,
                 count(*) filter (where severity = 'ERROR') over () = 0 as is_valid, (select count(*) from raw_weather) as total_rows,
                 count(*) filter (where severity = 'ERROR') over () as error_count,
                 count(*) filter (where severity = 'WARNING') over () as warning_count from lines""",
        ),
        "dq_required_columns": _with([RAW_WEATHER], _dq(DQ_REQUIRED, "raw_weather")),
        "dq_not_null": _with([RAW_WEATHER], _dq(DQ_NOT_NULL, "raw_weather")),
        "dq_numeric_range": _with(
            [RAW_WEATHER],
            _dq(
                [_range("numeric_range", TEMPERATURE_MAX, 15, None), _range("numeric_range", TEMPERATURE_MAX, None, 50)],
                "raw_weather",
            ),
        ),
        "dq_no_duplicates": """
            select 'no_duplicates' as rule, null::varchar as "column", 'ERROR' as severity,
                   cast(sum(n - 1) as bigint) as rows_affected
            from (select l_orderkey, l_linenumber, count(*) as n from lineitem group by all) having sum(n - 1) > 0""",
        "dq_no_duplicates_all_columns": _with(
            [HOURLY],
            """select 'no_duplicates' as rule, null::varchar as "column", 'ERROR' as severity,
               (select count(*) from hourly) - (select count(*) from (select distinct * from hourly)) as rows_affected""",
        ),
        "dq_data_type": _with(
            [RAW_WEATHER],
            f"""select 'data_type' as rule, '{TEMPERATURE}' as "column", 'ERROR' as severity, count(*) as rows_affected,
                  (select string_agg(v, '|' order by v) from (select "{TEMPERATURE}" as v from raw_weather
                     where "{TEMPERATURE}" is not null and (try_cast("{TEMPERATURE}" as double) is null or "{TEMPERATURE}" = 'nan')
                     order by v limit 5)) as amostra
                from raw_weather
                where "{TEMPERATURE}" is not null and (try_cast("{TEMPERATURE}" as double) is null or "{TEMPERATURE}" = 'nan')
                union all
                select 'data_type', 'Data', 'ERROR', count(*), 'nan|nan|nan|nan|nan' from raw_weather where "Data" = 'nan'""",
        ),
        "dq_temperatura": _with([RAW_WEATHER], _dq(DQ_TEMPERATURE, "raw_weather")),
        "dq_umidade": _with([RAW_WEATHER], _dq(DQ_HUMIDITY, "raw_weather")),
        "dq_area": _with([FARMS], _dq(DQ_AREA, "farms")),
        "dq_producao": _with([FARMS], _dq(DQ_PRODUCTION, "farms")),
        "dq_ano": _with([FARMS], _dq(DQ_YEAR, "farms")),
        "dq_quantidade": _with([FARMS], _dq(DQ_QUANTITY, "farms")),
        "dq_ph": _with([SOILS], _dq(DQ_PH, "soils")),
        "dq_profundidade": _with([SOILS], _dq(DQ_DEPTH, "soils")),
        "dq_percentual": _with([SOILS], _dq(DQ_PERCENTAGE, "soils")),
        "dq_report_clima": _with(
            [RAW_WEATHER], _dq([NOT_EMPTY, *DQ_NOT_NULL, *DQ_TEMPERATURE, *DQ_HUMIDITY], "raw_weather")
        ),
        "dq_report_agricultura": _with(
            [FARMS], _dq([NOT_EMPTY, *DQ_AREA, *DQ_PRODUCTION, *DQ_YEAR, *DQ_QUANTITY], "farms")
        ),
        "dq_report_solos": _with([SOILS], _dq([NOT_EMPTY, *DQ_PH, *DQ_DEPTH, *DQ_PERCENTAGE], "soils")),
        "dq_profile": _with(
            [HOURLY],
            "\nunion all ".join(
                f"""select '{c}' as "column", count(*) as row_count, 13 as column_count,
                    count(*) - count("{c}") as null_count from hourly"""
                for c in ("estacao_codigo", "estacao_nome", "uf", "data", "hora_utc", *MEASURES)
            ),
        ),
        "dq_quarantine_files": _with(
            [RAW_WEATHER, FILE_COUNTS],
            """select arquivo_origem,
                 case when sem_data > 0 then 'not_null' else 'umidade_valida' end as rule,
                 cast((sem_data > 0)::int + (umidade_ruim > 0)::int as bigint) as erros
               from por_arquivo where sem_data > 0 or umidade_ruim > 0""",
        ),
        "dq_clean_rows": _with(
            [RAW_WEATHER, FILE_COUNTS],
            """select r.arquivo_origem, r."Data" as data, r."Hora UTC" as hora_utc from raw_weather r
               join por_arquivo p using (arquivo_origem) where sem_data = 0 and umidade_ruim = 0""",
        ),
        "dq_rejected_rows": _with(
            [RAW_WEATHER, FILE_COUNTS],
            """select r.arquivo_origem, r."Data" as data, r."Hora UTC" as hora_utc from raw_weather r
               join por_arquivo p using (arquivo_origem) where sem_data > 0 or umidade_ruim > 0""",
        ),
        "dq_warehouse_not_null": _with(
            [HOURLY, RAW_CROPS],
            f"""{_dq([_nulls("data")], "hourly")}
               union all {_dq([_nulls("cultura", "WARNING")],
                 "(select cultura from raw_crops union all select null from supplier)")}""",
        ),
        "layer_totals": _with(
            [HOURLY, DATED, RAW_CROPS],
            """select 'clima' as fonte, count(*) as registros, 'success' as status from dated
               union all select 'culturas', count(*), 'success' from raw_crops
               union all select 'total', (select count(*) from dated) + (select count(*) from raw_crops), 'success'""",
        ),
        "table_not_empty": _with([HOURLY], "select count(*) > 0 as tem_registros from hourly"),
        "ingest_metrics": _with([RAW_WEATHER, TREE], _ingested("arquivo")),
        "ingest_filtered": _with([RAW_WEATHER, TREE], _ingested("(select * from arquivo where year = '1997' and part % 2 = 0)")),
        "ingest_stored": _with([RAW_WEATHER, TREE], "select year, part, linhas from arquivo where ruins = 0"),
        # Round trips through files and tables
        "raw_roundtrip": _with(
            [RAW_WEATHER],
            f"""select coalesce(substr("Data", 1, 4), 'raw') as year, "Data" as data, "Hora UTC" as hora_utc,
                "{TEMPERATURE}" as temperatura, arquivo_origem from raw_weather""",
        ),
        "year_filter_scan": _with(
            [RAW_WEATHER],
            f"""select '1997' as year, "Data" as data, "Hora UTC" as hora_utc, "{TEMPERATURE}" as temperatura,
                arquivo_origem from raw_weather where substr("Data", 1, 4) = '1997'""",
        ),
        "gold_partition_roundtrip": _with(
            FACT,
            "select cultura, ano, estacao, score_final, risco_geral from fato where estacao = 'Verão'",
        ),
        "csv_weather_scan": _with(
            [RAW_WEATHER],
            f"""select nullif("Data", 'nan') as data, "Hora UTC" as hora_utc, "{RAIN}" as chuva,
                nullif("{HUMIDITY}", '') as umidade from raw_weather""",
        ),
        "csv_crop_scan": _with([RAW_CROPS], "select * from raw_crops"),
        "csv_mixed_layouts": _with(
            [RAW_WEATHER],
            f"""select {lake_day} as data, "Hora UTC" as hora_utc, {_blank(RAIN)} as precipitacao_mm,
                {_blank(HUMIDITY)} as umidade_pct from raw_weather where {lake_day} is not null""",
        ),
        "csv_quoted_cells": _with(
            [RAW_CROPS], "select cultura, categoria || ', a' || chr(10) || 'b, ' || cultura as categoria from raw_crops"
        ),
        "ingest_two_runs": _with(
            [RAW_WEATHER],
            """select coalesce(substr("Data", 1, 4), 'raw') as year, count(*) as linhas from raw_weather group by all""",
        ),
        "raw_mixed_schemas": _with(
            [RAW_WEATHER],
            f"""select coalesce(substr("Data", 1, 4), 'raw') as year, count(*) as linhas,
                sum(case when substr("Data", 1, 4) >= '1996' and "{HUMIDITY}" is not null then 1 else 0 end)::bigint as com_umidade
                from raw_weather group by all""",
        ),
        "load_table": _with(
            [HOURLY, DATED],
            """select estacao_codigo, estacao_nome, nullif(uf, 'U07') as uf, count(*) as registros
               from dated group by all""",
        ),
        "load_again": _with(
            [HOURLY, DATED],
            "select estacao_codigo, estacao_nome, uf, count(*) as registros from dated where hora_utc <> '0100 UTC' group by all",
        ),
        "lasting_view": _with([HOURLY, STAGED], "select estacao_codigo, estacao_nome, uf, count(*) as registros from staged group by all"),
        "previews": _with(
            FACT,
            """select 'diario' as tabela, data::varchar as c0, estacao_codigo as c1, qtd_registros::varchar as c2
                 from (select * from diario order by data, estacao_codigo limit 20)
               union all select 'mensal', ano::varchar, mes::varchar, estacao_codigo
                 from (select * from mensal order by ano, mes, estacao_codigo limit 20)
               union all select 'fato', cultura, estacao, ano::varchar from (select * from fato order by cultura, estacao, ano limit 20)""",
        ),
        "extreme_means": _with(
            [HOURLY],
            f"""select estacao_codigo, case when large then round(sum(v) / count(v), 1) else {_mean("few")} end as media,
                  case when large then min(v) else {_low("few")} end as minimo, case when large then max(v) else {_high("few")} end as maximo,
                  case when large then sum(v) else {_total("few")} end as total
                from (select *, case when abs(v) < 1e9 then v end as few, max(abs(v)) over (partition by estacao_codigo) >= 1e9 as large from (
                  select estacao_codigo, case cast(substr(estacao_codigo, 2, 9) as bigint) % 4 when 0 then 0.0499999::double
                    when 1 then 2.0::double ** 77 when 2 then 2e15::double else temperatura_c end as v from hourly))
                group by estacao_codigo, large""",
        ),
    }
    same = {"warehouse_models": "fct_risco_climatico", "stored_layers": "clima_estacional", "clean_counts_on_write": "clean_counts"}
    return queries | {name: queries[other] for name, other in same.items()}
