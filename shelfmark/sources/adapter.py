"""Raw retail tables derived from the benchmark star schema.

Every driver row is used once; defects are planted by key arithmetic so that each
cleaning and validation rule has something to find (see FIXTURES.md). No row is dropped
and no window is needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    """The three retail tables, raw, cleaned or validated."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame

    def items(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "products": self.products, "orders": self.orders}


def _key(prefix: str, key: str) -> str:
    """Padded to 12 digits at least; ``lpad`` alone would also cut longer keys."""
    text = f"cast({key} as string)"
    return f"concat('{prefix}', if(length({text}) < 12, lpad({text}, 12, '0'), {text}))"


def _sales_orders(orders: DataFrame) -> DataFrame:
    """Order heads with two kinds of customer behaviour planted.

    Customers 9, 29, 49, ... hand their orders to the customer before them and stay
    without orders; two other groups place all orders early and then go quiet.
    """
    return orders.selectExpr(
        "o_orderkey",
        "o_orderpriority",
        "if(o_custkey % 20 = 9, o_custkey - 1, o_custkey) as custkey",
        "datediff(cast(o_orderdate as date), date'1995-01-01') as day",
    ).selectExpr(
        "o_orderkey",
        "o_orderpriority",
        "custkey",
        """date_add(date'1995-01-01',
             case when custkey % 7 = 1 then day % 540
                  when custkey % 3 = 0 then day % 1825
                  else day end) as order_date""",
    )


def raw_customers(
    customer: DataFrame, nation: DataFrame, region: DataFrame, orders: DataFrame
) -> DataFrame:
    first_order = _sales_orders(orders).groupBy("custkey").agg({"order_date": "min"})
    joined = (
        customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .join(first_order, customer["c_custkey"] == first_order["custkey"], "left")
    )
    # Every 125th customer arrives twice; the second copy has a longer name.
    copies = joined.selectExpr(
        "c_custkey as k",
        "if(c_custkey % 40 = 1, concat('  ', upper(c_name), ' '), c_name) as name",
        "lower(n_name) as city",
        "lower(substring(r_name, 1, 2)) as state",
        "coalesce(`min(order_date)`, date'1995-01-01') as first_day",
        "explode(if(c_custkey % 125 = 0, array(0, 1), array(0))) as copy",
    )
    return copies.selectExpr(
        "k * 2 + copy as src_seq",
        f"{_key('CUST_', 'k')} as customer_id",
        "if(copy = 1, concat(name, ' Dup'), name) as name",
        """case when k % 100 = 7 then null when k % 30 = 2 then 'M' when k % 30 = 4 then 'FEMALE'
                when k % 90 = 6 then 'n/a' when k % 2 = 0 then 'Male' else 'Female'
           end as gender""",
        """case when k % 67 = 3 then null when k % 211 = 5 then 150.0D
                else cast(18 + (k * 7) % 63 as double) end as age""",
        "city",
        "state",
        """if(k % 97 = 11, date_add(first_day, 5), date_sub(first_day, cast(k % 60 as int)))
           as signup_date""",
    )


def raw_products(part: DataFrame) -> DataFrame:
    # A second copy of every 450th product repeats the id of the product before it.
    copies = part.selectExpr(
        "p_partkey as k",
        "p_name",
        "p_type",
        "p_size",
        "cast(p_retailprice as decimal(18,2)) as list_price",
        "explode(if(p_partkey % 450 = 1, array(0, 1), array(0))) as copy",
    )
    return copies.selectExpr(
        "k * 2 + copy as src_seq",
        f"{_key('PROD_', 'k - copy')} as product_id",
        "p_name as product_name",
        """case when copy = 1 then p_type when k % 100 = 7 then null
                when k % 50 = 3 then concat(' ', lower(p_type)) else p_type end as category""",
        "cast(if(k % 400 = 11, 0, list_price) as decimal(18,2)) as price",
        """cast(case when copy = 1 then list_price when k % 170 = 13 then null
                     when k % 600 = 21 then 0 when k % 500 = 17 then list_price + 10
                     else cast(list_price * cast(35 + p_size as decimal(5,0))
                               * cast(0.01 as decimal(3,2)) as decimal(18,2))
                end as decimal(18,2)) as cost""",
    )


def raw_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    heads = _sales_orders(orders)
    lines = lineitem.selectExpr(
        "l_orderkey as ok",
        "l_linenumber as ln",
        "l_partkey as pk",
        "l_suppkey as sk",
        "cast(l_quantity as int) as qty",
        "l_returnflag = 'R' and l_linenumber <= 3 as returned",
        "l_linestatus = 'O' as is_open",
    )
    # Lines of every 40th order keep the repeated (order, line) pairs of the source as
    # repeated ids; elsewhere part, supplier and quantity make the id unique. The sequence is a
    # decimal: part and supplier keys up to 10**12 neither collide nor overflow in it.
    return lines.join(heads, lines["ok"] == heads["o_orderkey"]).selectExpr(
        "cast((cast(pk as decimal(19,0)) * 1000000000000 + sk) * 64 + qty as decimal(38,0)) as src_seq",
        f"""concat_ws('_', {_key('ORD_', 'ok')}, cast(ln as string),
              if(ok % 40 = 0, null, concat_ws('_', pk, sk, qty))) as order_id""",
        f"if(ok % 997 = 5, 'CUST_GHOST', {_key('CUST_', 'custkey')}) as customer_id",
        f"{_key('PROD_', 'pk')} as product_id",
        "order_date",
        """cast(case when (ok * 7 + ln) % 300 = 1 then -1 - qty % 3
                     when (ok * 7 + ln) % 600 = 2 then 0
                     else 1 + qty % 8 end as int) as quantity""",
        """case when ok % 200 = 9 then null
                when o_orderpriority like '1%' then if(ok % 3 = 0, 'CC', 'Credit Card')
                when o_orderpriority like '2%' then if(ok % 3 = 0, ' paypal ', 'PayPal')
                when o_orderpriority like '3%' then 'Debit_Card'
                when o_orderpriority like '4%' then 'COD'
                else if(ok % 7 = 0, 'Bank Transfer', 'apple pay') end as payment_method""",
        """case when custkey % 20 = 19 then 'Cancelled'
                when returned then if(is_open, 'cancelled', 'Refunded')
                else if(is_open, 'Shipped', ' completed') end as order_status""",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Read the driver parquet tables and derive the raw retail tables, lazily."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    orders, lineitem = table("orders"), table("lineitem")
    return Tables(
        customers=raw_customers(table("customer"), table("nation"), table("region"), orders),
        products=raw_products(table("part")),
        orders=raw_orders(lineitem, orders),
    )
