"""SQL text that gives the same rows as the named queries, for a second engine.

The formulations differ on purpose: days are exploded rows and set operations
here, arrays there; history is told by self-joins here, by windows there.
"""

from __future__ import annotations

import re

# Common table expressions by name; a check takes the ones it mentions.
PARTS = {
    "trip_src": """
        select year(o_orderdate) as feed_id, (year(o_orderdate)*3)%7 as feed_seq,
          lpad(cast(o_custkey as varchar),6,'0') as cislo_linka, o_orderkey as cislo_spoj,
          case o_orderpriority when '1-URGENT' then 'X' when '2-HIGH' then '6,+'
            when '3-MEDIUM' then '' when '4-NOT SPECIFIED' then '1,3,5' else 'X,+' end as kody
        from orders""",
    "feeds": "select distinct feed_id, feed_seq from trip_src",
    "line_nr": """
        select distinct feed_id, feed_seq, cislo_linka, cast(cislo_linka as int) as nr
        from trip_src""",
    "line_src": """
        select feed_id, feed_seq, cislo_linka,
          make_date(case when feed_id=1997 and nr%10 in (0,1) then 2001 else feed_id end,1,1)
            as platnost_od,
          case when feed_id=1997 and nr%10=0 then make_date(2001,12,31)
               when feed_id=1997 and nr%10=1 then make_date(2001,6,30)
               else make_date(feed_id,12,31) end as platnost_do,
          lpad(cast(nr % (select count(*) from supplier) as varchar),8,'0') as ico,
          c_name as nazev_linka,
          substring('AELMPT', cast(nr%6+1 as int), 1) as dopravni_prostredek, 1 as rozl_linka
        from line_nr join customer on c_custkey = nr""",
    "carrier_src": """
        select feed_id, feed_seq, s_suppkey, lpad(cast(s_suppkey as varchar),8,'0') as ico,
          case when s_suppkey%10=0 and feed_id>=1999 then concat(s_name,' a.s.')
               else s_name end as jmeno,
          n_name as sidlo, 1 as rozliseni,
          case when s_suppkey%3=0 then ''
               else concat('www.c',cast(s_suppkey as varchar),'.example') end as www
        from supplier join nation on s_nationkey=n_nationkey
        join carrier_used on carrier = s_suppkey""",
    "carrier_used": """
        select feed_id, feed_seq, nr % (select count(*) from supplier) as carrier from line_nr
        union
        select feed_id, feed_seq, cislo_spoj % (select count(*) from supplier)
        from trip_src where cislo_spoj%9=0""",
    "stop_src": """
        select feed_id, feed_seq, p_partkey as cislo_zastavka, p_brand as obec,
          p_type as cast_obce, p_name as misto
        from part join stop_used on stop = p_partkey""",
    "stop_used": """
        select distinct feed_id, feed_seq, l_partkey as stop
        from lineitem join trip_src on cislo_spoj = l_orderkey""",
    "altdop": """
        select cislo_spoj,
          lpad(cast(cislo_spoj % (select count(*) from supplier) as varchar),8,'0') as ico
        from trip_src where cislo_spoj%9=0""",
    "caskody": """
        select l_orderkey as cislo_spoj, cast(1+l_partkey%8 as varchar) as typ,
          cast(l_shipdate as date) as od,
          case when l_partkey%8 in (6,7) or (l_partkey%8 in (0,3) and l_suppkey%5<>0)
               then cast(cast(l_shipdate as date) + cast(l_quantity as int) as date) end as do_
        from lineitem where l_orderkey%4<>0""",
    "calls0": """
        select l_orderkey as cislo_spoj, l_partkey as cislo_zastavka, l_quantity, l_linestatus,
          cast(row_number() over (partition by l_orderkey
            order by l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_shipdate,l_quantity)
            as int) as cislo_tarifni,
          cast(count(*) over (partition by l_orderkey) as int) as n
        from lineitem""",
    "calls1": """
        select *, case when cislo_spoj%2=1 then cislo_tarifni else n+1-cislo_tarifni end as ord
        from calls0""",
    "calls2": "select *, cast((cislo_spoj*37 + 11*ord)%1440 as int) as t from calls1",
    "call_src": """
        select cislo_spoj, cislo_tarifni, cislo_zastavka,
          case when cislo_spoj%13<>0 then 2*ord end as km,
          case when l_quantity=1 then '<' when l_quantity=2 then '|'
               when l_quantity=3 or (l_linestatus='F' and ord<n) or ord=1 then ''
               else concat(lpad(cast(cast(floor(t/60) as int) as varchar),2,'0'),
                           lpad(cast(t%60 as varchar),2,'0')) end as prijezd,
          case when l_quantity=1 then '<' when l_quantity=2 then '|'
               when l_quantity=3 or ord=n then ''
               else concat(lpad(cast(cast(floor(t/60) as int) as varchar),2,'0'),
                           lpad(cast(t%60 as varchar),2,'0')) end as odjezd
        from calls2""",
    "loc_id": """
        select p_partkey as cislo_zastavka,
          cast(49 as double)+cast(p_partkey%1000 as double)/1000 as x,
          cast(13 as double)+cast(p_partkey%700 as double)/100 as y
        from part where p_partkey%4<>0""",
    "loc_name": """
        select concat(p_brand,',',p_type,',',p_name) as nazev, min(x) as x, min(y) as y
        from loc_id join part on p_partkey = cislo_zastavka group by 1""",
    # Line history by self-joins.
    "hist0": """
        select l.*, (select max(e.platnost_od) from line_src e
                     where e.cislo_linka=l.cislo_linka and e.feed_seq<l.feed_seq) as latest
        from line_src l""",
    "candidates": "select * from hist0 where latest is null or platnost_od >= latest",
    "followed": """
        select c.*, (select max(p.feed_seq) from candidates p
                     where p.cislo_linka=c.cislo_linka and p.feed_seq<c.feed_seq) as before_seq
        from candidates c""",
    "accepted": """
        select f.* from followed f left join candidates p
          on p.cislo_linka=f.cislo_linka and p.feed_seq=f.before_seq
        where p.feed_seq is null or p.platnost_od<>f.platnost_od
          or p.platnost_do<>f.platnost_do""",
    "succeeded": """
        select a.*, (select min(n.feed_seq) from accepted n
                     where n.cislo_linka=a.cislo_linka and n.feed_seq>a.feed_seq) as next_seq
        from accepted a""",
    "versions": """
        select s.feed_id, s.feed_seq, s.cislo_linka, n.platnost_od as next_od,
          s.next_seq is null as aktualni
        from succeeded s left join accepted n
          on n.cislo_linka=s.cislo_linka and n.feed_seq=s.next_seq""",
    "history": """
        select l.*, v.feed_id is not null as prijata, coalesce(v.aktualni,false) as aktualni,
          coalesce(v.next_od, l.platnost_do) as konec,
          md5(concat_ws(chr(31), l.feed_id, l.cislo_linka, 1)) as linka_id,
          md5(concat_ws(chr(31), c.ico, c.jmeno, c.sidlo)) as dopravce_id, c.jmeno as dopravce
        from line_src l
        left join versions v on v.feed_id=l.feed_id and v.cislo_linka=l.cislo_linka
        join carrier_src c on c.feed_id=l.feed_id and c.ico=l.ico""",
    "attached": """
        select t.*, h.linka_id, h.aktualni, h.platnost_od, h.platnost_do, h.konec,
          h.nazev_linka, h.dopravce,
          md5(concat_ws(chr(31), t.feed_id, t.cislo_linka, 1, t.cislo_spoj)) as spoj_id
        from trip_src t join history h
          on h.feed_id=t.feed_id and h.cislo_linka=t.cislo_linka
        where h.prijata""",
    "stop_rows": """
        select *, md5(concat_ws(chr(31), obec, cast_obce, misto)) as zastavka_id from stop_src""",
    "stop_first": """
        select * from stop_rows
        qualify row_number() over (partition by obec, cast_obce, misto
                                   order by feed_seq, cislo_zastavka)=1""",
    "served": """
        select c.*, t.feed_id, t.cislo_linka from call_src c join trip_src t using (cislo_spoj)
        where prijezd not in ('<','|') and odjezd not in ('<','|')""",
    # Holidays: fixed days and Easter by the anonymous Gregorian rule.
    "easter0": """
        select y, y%19 as a, y//100 as b, y%100 as c
        from (select unnest(generate_series(1970, 2040)) as y)""",
    "easter1": "select *, b//4 as d, b%4 as e, (b-(b+8)//25+1)//3 as g, c//4 as i, c%4 as k from easter0",
    "easter2": "select *, (19*a+b-d-g+15)%30 as h from easter1",
    "easter3": "select *, (32+2*e+2*i-h-k)%7 as l from easter2",
    "easter4": "select *, (a+11*h+22*l)//451 as m from easter3",
    "easter": "select y, make_date(y, (h+l-7*m+114)//31, (h+l-7*m+114)%31+1) as sunday from easter4",
    "hol": """
        select y, sunday-2 as d from easter union select y, sunday+1 from easter
        union select y, make_date(y,mm,dd) from easter,
          (values (1,1),(5,1),(5,8),(7,5),(7,6),(9,28),(10,28),(12,24),(12,25),(12,26)) f(mm,dd)""",
    # Calendars: flags, dated codes and days as rows. ``tr`` is given by the check.
    "fl0": """
        select trip, vf, vt,
          case when list_contains(k,'X') then 1 else 0 end as x,
          case when list_contains(k,'+') then 1 else 0 end as p,
          case when list_contains(k,'1') then 1 else 0 end as d1,
          case when list_contains(k,'2') then 1 else 0 end as d2,
          case when list_contains(k,'3') then 1 else 0 end as d3,
          case when list_contains(k,'4') then 1 else 0 end as d4,
          case when list_contains(k,'5') then 1 else 0 end as d5,
          case when list_contains(k,'6') then 1 else 0 end as d6,
          case when list_contains(k,'7') then 1 else 0 end as d7
        from (select *, string_split(kody, ',') as k from tr)""",
    "fl1": "select *, x+p+d1+d2+d3+d4+d5+d6+d7=0 as kazdy from fl0",
    "fl": """
        select trip, vf, vt, x, p,
          case when kazdy or x=1 or d1=1 then 1 else 0 end as m1,
          case when kazdy or x=1 or d2=1 then 1 else 0 end as m2,
          case when kazdy or x=1 or d3=1 then 1 else 0 end as m3,
          case when kazdy or x=1 or d4=1 then 1 else 0 end as m4,
          case when kazdy or x=1 or d5=1 then 1 else 0 end as m5,
          case when kazdy or d6=1 then 1 else 0 end as m6,
          case when kazdy or p=1 or d7=1 then 1 else 0 end as m7
        from fl1""",
    "wd": """
        select trip, 1 as dow from fl where m1=1 union all select trip, 2 from fl where m2=1
        union all select trip, 3 from fl where m3=1 union all select trip, 4 from fl where m4=1
        union all select trip, 5 from fl where m5=1 union all select trip, 6 from fl where m6=1
        union all select trip, 7 from fl where m7=1""",
    "code_stats": """
        select cislo_spoj as trip, cast(count(*) as int) as n,
          max(case when typ in ('1','3','5','6','7','8') then 1 else 0 end) as jen_dny,
          min(typ) as typ, min(od) as od, min(do_) as do_
        from caskody group by 1""",
    "per": """
        select f.trip, f.x, f.p, coalesce(s.n,0)=1 and s.typ='1' as jediny,
          case when s.n=1 and s.typ='1' then s.od else f.vf end as od,
          case when s.n=1 and s.typ='1' then coalesce(s.do_,s.od) else f.vt end as do_,
          (s.n=1 and s.typ='1') or coalesce(s.jen_dny,0)=0 as cal
        from fl f left join code_stats s using (trip)""",
    "spans": """
        select distinct f.trip, f.x, f.p, c.typ, c.od, c.do_,
          case when c.typ in ('5','6') then f.vf else c.od end as a,
          case when c.typ in ('5','6') then f.vt else c.do_ end as b
        from caskody c join fl f on f.trip=c.cislo_spoj join per on per.trip=f.trip
        where not per.jediny""",
    "span_days": """
        select trip, x, p, typ, cast(d as date) as d from (
          select trip, x, p, typ, unnest(generate_series(a, b, interval 1 day)) as d
          from spans where b is not null and typ not in ('2','3'))""",
    "week_days": """
        select s.* from span_days s join wd on wd.trip=s.trip and wd.dow=isodow(s.d)
        where case when typ in ('5','7') then week(d)%2=1
                   when typ in ('6','8') then week(d)%2=0 else true end""",
    "span_hol": """
        select s.trip, s.x, s.p, s.typ, h.d from spans s join hol h on h.d between s.a and s.b
        where s.b is not null and s.typ not in ('2','3')
          and case when typ in ('5','7') then week(h.d)%2=1
                   when typ in ('6','8') then week(h.d)%2=0 else true end""",
    # A working-day code drops holidays only inside its own range, hence one row per code.
    "added1": """
        select trip, d from week_days w where typ='1' and (x=0 or p=1)
        union select trip, d from week_days w
          where typ='1' and x=1 and p=0 and d not in (select d from hol where isodow(d)<6)
        union select trip, d from span_hol where typ='1' and x=1 and p=1 and isodow(d)=6
        union select trip, d from span_hol where typ='1' and x=0 and p=1 and isodow(d)<7
        union select trip, od from spans where typ='1' and do_ is null""",
    "added23": "select distinct trip, od as d from spans where typ in ('2','3')",
    "added58": """
        select trip, d from week_days
          where typ in ('5','6','7','8')
            and (x=0 or d not in (select d from hol where isodow(d)<6))
        union select trip, d from span_hol
          where typ in ('5','6','7','8') and p=1 and isodow(d)<7""",
    "excluded4": """
        select trip, d from week_days where typ='4'
        union select trip, d from span_hol where typ='4' and p=1 and isodow(d)<7
        union select trip, od from spans where typ='4' and do_ is null""",
    "added": "select * from added1 union select * from added23 union select * from added58",
    "per_hol": """
        select per.trip, per.x, per.p, h.d from per join hol h on h.d between per.od and per.do_
        where per.cal""",
    "skipped": """
        select trip, d from per_hol where x=1 and isodow(d)<6 except select * from added""",
    "not_all": "select * from excluded4 union select * from skipped",
    "gained": """
        select trip, d from per_hol where p=1 and isodow(d)<7 except select * from not_all""",
    "run_days": "select * from added union select * from gained except select * from not_all",
    "not_days": "select n.* from not_all n join per using (trip) where per.cal",
    "run_text": """
        select trip, string_agg(cast(d as varchar), ',' order by d) as jede,
          string_agg(cast(d - date '1970-01-01' as varchar), ',' order by d) as jede_cisla
        from run_days group by 1""",
    "not_text": """
        select trip, string_agg(cast(d as varchar), ',' order by d) as nejede,
          string_agg(cast(d - date '1970-01-01' as varchar), ',' order by d) as nejede_cisla
        from not_days group by 1""",
    "svc0": """
        select per.trip, per.cal, f.m1, f.m2, f.m3, f.m4, f.m5, f.m6, f.m7, f.x, f.p,
          m1+2*m2+4*m3+8*m4+16*m5+32*m6+64*m7 as maska, per.od, per.do_,
          coalesce(jede,'') as jede, coalesce(nejede,'') as nejede,
          coalesce(jede_cisla,'') as jede_cisla, coalesce(nejede_cisla,'') as nejede_cisla
        from per join fl f using (trip) left join run_text using (trip)
        left join not_text using (trip)""",
    "svc": """
        select *, case when cal
          then md5(concat_ws(chr(31),'weekly',maska,od,do_,x,p,jede_cisla,nejede_cisla))
          else md5(concat_ws(chr(31),'listed',jede_cisla)) end as service_id
        from svc0""",
    "svc_one": "select * from svc qualify row_number() over (partition by service_id order by trip)=1",
    "wide0": """
        select c.*, a.linka_id, a.platnost_od, a.konec, a.nazev_linka, a.dopravce,
          s.zastavka_id,
          case when odjezd<>'' then substring(odjezd,1,2)||':'||substring(odjezd,3,2)||':00'
               when prijezd<>'' then substring(prijezd,1,2)||':'||substring(prijezd,3,2)||':00'
               else '00:00:00' end as cas,
          case when c.cislo_spoj%2=1 then cislo_tarifni else -cislo_tarifni end as smer
        from served c join attached a using (cislo_spoj)
        join stop_rows s on s.feed_id=c.feed_id and s.cislo_zastavka=c.cislo_zastavka""",
    "wide1": """
        select *, lag(1) over w as pred, lead(1) over w as po from wide0 where {wide_filter}
        window w as (partition by platnost_od, cislo_linka, cislo_spoj
                     order by km nulls last, cas, smer, zastavka_id, cislo_tarifni)""",
}

TRIPS_OF_ALL_LINES = """
        select t.cislo_spoj as trip, l.platnost_od as vf, l.platnost_do as vt, t.kody
        from trip_src t join line_src l
          on l.feed_id=t.feed_id and l.cislo_linka=t.cislo_linka"""
TRIPS_OF_ACCEPTED_LINES = """
        select cislo_spoj as trip, platnost_od as vf, platnost_do as vt, kody from attached"""


def _check(body: str, tr: str = TRIPS_OF_ALL_LINES, wide_filter: str = "true") -> str:
    parts = {**PARTS, "tr": tr}
    parts["wide1"] = parts["wide1"].format(wide_filter=wide_filter)
    needed: dict[str, str] = {}

    def need(text: str) -> None:
        for word in re.findall(r"\w+", text):
            if word in parts and word not in needed:
                need(parts[word])
                needed.setdefault(word, parts[word])

    need(body)
    # The second engine fails on joins with unions inside, unless these are made first.
    first = {"carrier_src", "stop_src"}
    ctes = ",\n".join(
        f"{name} as {'materialized ' if name in first else ''}({text})"
        for name, text in needed.items()
    )
    return f"with {ctes}\n{body}"


def _day_sets(source: str) -> str:
    return _check(f"""
        select tr.trip as trip_number, count(d) as n_days, cast(min(d) as varchar) as first_day,
          cast(max(d) as varchar) as last_day,
          md5(coalesce(string_agg(cast(d - date '1970-01-01' as varchar), ',' order by d), ''))
            as days_digest
        from tr left join (select distinct trip, d from {source}) s on s.trip=tr.trip
        group by 1""")


_FLAGS = ", ".join(
    f"cast(m{i} as int) as {day}"
    for i, day in enumerate(
        ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"), 1
    )
)
_HISTORY = """
        select cast(feed_id as int) as feed_id, cast(feed_seq as int) as feed_seq,
          cislo_linka as line_number, cast(platnost_od as varchar) as valid_from,
          cast(platnost_do as varchar) as loaded_to, cast(konec as varchar) as valid_to,
          cast(prijata as int) as is_accepted, cast(aktualni as int) as is_current
        from history"""
_STOP_ROW = """cast(cislo_zastavka as bigint) as stop_number, obec as municipality,
          cast_obce as district, misto as place, cast(feed_seq as int) as first_feed"""
_NAME = "concat(obec,',',cast_obce,',',misto)"
_SHIFTED = """case when try_cast(substring({t},1,1) as int) < try_cast(substring(prvni,1,1) as int)
            then cast(cast(substring({t},1,2) as int)+24 as varchar)
            else substring({t},1,2) end || ':' || substring({t},3,2) || ':00'"""

_SHIFTED_BY_MINUTE = """case when prvni<>'' and {t}<prvni
            then cast(cast(substring({t},1,2) as int)+24 as varchar)
            else substring({t},1,2) end || ':' || substring({t},3,2) || ':00'"""


def _stop_times(clock: str) -> str:
    arrival, departure = clock.format(t="pr"), clock.format(t="od")
    return _check(f"""
        , timed as (
          select c.*, a.spoj_id, s.zastavka_id,
            first_value(odjezd) over (partition by c.cislo_spoj order by
              case when c.cislo_spoj%2=1 then cislo_tarifni end,
              case when c.cislo_spoj%2=0 then cislo_tarifni end desc) as prvni,
            case when prijezd='' then odjezd else prijezd end as pr,
            case when odjezd='' then prijezd else odjezd end as od
          from served c join attached a using (cislo_spoj)
          join stop_rows s on s.feed_id=c.feed_id and s.cislo_zastavka=c.cislo_zastavka
          where a.aktualni and (prijezd<>'' or odjezd<>'')),
        shifted as (
          select *, {arrival} as arrival_time,
            {departure} as departure_time from timed)
        select spoj_id as trip_id, arrival_time, departure_time, zastavka_id as stop_id,
          cast(row_number() over (partition by spoj_id order by km nulls last, departure_time,
            arrival_time, case when cislo_spoj%2=1 then cislo_tarifni else -cislo_tarifni end,
            zastavka_id, cislo_tarifni) as int) as stop_sequence
        from shifted""")


CHECKS = {
    "version_layout": _check("""
        , v as (select distinct feed_id, '1.' || cast(8 + feed_id%5 as varchar) as verze from feeds)
        select cast(feed_id as varchar) as feed_id, 'lines' as "table",
          cislo_linka as line_number, nazev_linka as label,
          case when verze in ('1.10','1.11') then dopravni_prostredek else '' end as vehicle,
          cast(platnost_od as varchar) as valid_from, cast(platnost_do as varchar) as valid_to,
          case when verze in ('1.10','1.11') then 1 else -1 end as line_discriminator
        from line_src join v using (feed_id)
        where verze<>'1.12' and cast(cislo_linka as int)%7<>0
        union all
        select cast(feed_id as varchar), 'trips', cislo_linka,
          cast(cislo_spoj as varchar) || ':' || case kody when '' then ''
            else 'k' || replace(kody, ',', '/k') end, '', '', '',
          case when verze in ('1.10','1.11') then 1 else -1 end
        from trip_src join v using (feed_id) where verze<>'1.12'"""),
    "arity_guard": _check("""
        , v as (select distinct feed_id, '1.' || cast(8 + feed_id%5 as varchar) as verze from feeds),
        r as (
          select feed_id, 'lines' as t, cast(cislo_linka as int)%7=0 as kratky from line_src
          union all select feed_id, 'trips', false from trip_src)
        select cast(feed_id as varchar) as feed_id, t as "table",
          case when verze='1.12' then 'unknown version'
               when kratky then 'wrong number of fields' else '' end as reason,
          count(*) as n_rows
        from r join v using (feed_id) group by 1, 2, 3"""),
    "stop_calls": _check("""
        select a.spoj_id as trip_id, s.zastavka_id as stop_id, c.cislo_tarifni as tariff_number,
          c.km, c.prijezd as arrival, c.odjezd as departure
        from served c join attached a using (cislo_spoj)
        join stop_rows s on s.feed_id=c.feed_id and s.cislo_zastavka=c.cislo_zastavka"""),
    "trip_first_departure": _check("""
        select cast(feed_id as int) as feed_id, cislo_spoj as trip_number,
          odjezd as first_departure
        from served where prijezd<>'' or odjezd<>''
        qualify row_number() over (partition by cislo_spoj order by
          case when cislo_spoj%2=1 then cislo_tarifni end,
          case when cislo_spoj%2=0 then cislo_tarifni end desc)=1"""),
    "stop_times": _stop_times(_SHIFTED),
    "stop_times_by_minute": _stop_times(_SHIFTED_BY_MINUTE),
    "carriers": _check("""
        select md5(concat_ws(chr(31), ico, jmeno, sidlo)) as carrier_id, ico,
          jmeno as carrier_name, sidlo as seat, www, cast(feed_seq as int) as first_feed
        from carrier_src
        qualify row_number() over (partition by ico, jmeno, sidlo
                                   order by feed_seq, s_suppkey)=1"""),
    "agency": _check("""
        select distinct md5(concat_ws(chr(31), ico, jmeno, sidlo)) as agency_id,
          jmeno || ', ' || sidlo as agency_name, 'http://' || www as agency_url,
          'Europe/Prague' as agency_timezone, 'cs' as agency_lang, '' as agency_phone,
          '' as agency_email
        from carrier_src"""),
    "stops": _check(f"select zastavka_id as stop_id, {_STOP_ROW} from stop_first"),
    "stops_by_id": _check(f"""
        select md5(cast(cislo_zastavka as varchar)) as stop_id, {_STOP_ROW} from stop_src
        qualify row_number() over (partition by cislo_zastavka order by feed_seq)=1"""),
    "stop_locations": _check("select nazev as stop_name, x, y from loc_name"),
    "gtfs_stops": _check(f"""
        select zastavka_id as stop_id, {_NAME} as stop_name, cast(0 as double) as stop_lat,
          cast(0 as double) as stop_lon from stop_first"""),
    "stops_geo_by_id": _check(f"""
        select distinct md5(cast(s.cislo_zastavka as varchar)) as stop_id, {_NAME} as stop_name,
          coalesce(x, 0) as stop_lat, coalesce(y, 0) as stop_lon
        from stop_src s left join loc_id l on l.cislo_zastavka=s.cislo_zastavka"""),
    "stops_geo_by_name": _check(f"""
        select zastavka_id as stop_id, {_NAME} as stop_name, coalesce(x, 0) as stop_lat,
          coalesce(y, 0) as stop_lon
        from stop_first left join loc_name on nazev={_NAME}"""),
    "lines": _check("""
        select linka_id as line_id, dopravce_id as carrier_id, cislo_linka as line_number,
          nazev_linka as line_name, dopravni_prostredek as vehicle,
          cast(platnost_od as varchar) as valid_from, cast(platnost_do as varchar) as valid_to,
          1 as is_current
        from history"""),
    "line_history": _check(_HISTORY),
    "incremental_load": _check(_HISTORY),
    "incremental_tables": _check("""
        select 'carriers' as "table", md5(concat_ws(chr(31), ico, jmeno, sidlo)) as key,
          '' as parent, cast(min(feed_seq) as int) as feed_seq, 1 as is_current, '' as until
        from carrier_src group by ico, jmeno, sidlo
        union all select 'stops', zastavka_id, '', cast(feed_seq as int), 1, '' from stop_first
        union all select 'lines', linka_id, dopravce_id, cast(feed_seq as int),
          cast(aktualni as int), cast(konec as varchar) from history
        union all select 'trips', spoj_id, linka_id, cast(feed_seq as int),
          cast(aktualni as int), cast(platnost_do as varchar) from attached
        union all select 'calls', a.spoj_id || ':' || cast(c.cislo_tarifni as varchar),
          s.zastavka_id, cast(a.feed_seq as int), 1, ''
        from served c join attached a using (cislo_spoj)
        join stop_rows s on s.feed_id=c.feed_id and s.cislo_zastavka=c.cislo_zastavka"""),
    "stop_posts": _check("""
        select cast(feed_id as varchar) as feed_id, cast(cislo_zastavka as bigint) as stop_number,
          cast(post as int) as post_number,
          case when post<3 then 'post ' || cast(post as varchar) else '' end as post_name,
          substring(misto,1,12) as direction, '' as stand
        from (select *, unnest(range(1, cislo_zastavka%3+2)) as post from stop_src
              where cislo_zastavka%2=0 and feed_id%5 in (2,3))
        where cislo_zastavka%11<>0 or post<>1"""),
    "findings": _check(
        """
        , agency as (select distinct md5(concat_ws(chr(31), ico, jmeno, sidlo)) as id
                     from carrier_src where www<>''),
        given as (select distinct zastavka_id as id from stop_rows where cislo_zastavka%4<>0),
        dated as (
          select service_id from svc where cal union select service_id from svc
          where jede<>'')
        select distinct 'routes: agency_id not in agency' as "check", dopravce_id as key
        from history where aktualni and dopravce_id not in (select id from agency)
        union select 'stop_times: stop_id not in stops', s.zastavka_id
        from served c join attached a using (cislo_spoj)
        join stop_rows s on s.feed_id=c.feed_id and s.cislo_zastavka=c.cislo_zastavka
        where a.aktualni and (prijezd<>'' or odjezd<>'')
          and s.zastavka_id not in (select id from given)
        union select 'trips: service without days', service_id
        from svc join attached a on a.cislo_spoj=svc.trip
        where a.aktualni and service_id not in (select service_id from dated)""",
        TRIPS_OF_ACCEPTED_LINES,
    ),
    "routes": _check("""
        select linka_id as route_id, dopravce_id as agency_id, cislo_linka as route_short_name,
          nazev_linka as route_long_name,
          case dopravni_prostredek when 'E' then 0 when 'M' then 1 when 'L' then 6
            when 'P' then 4 else 3 end as route_type
        from history where aktualni"""),
    "trips": _check("""
        select spoj_id as trip_id, linka_id as route_id, cast(platnost_od as varchar)
          as loaded_from, cast(platnost_do as varchar) as loaded_to,
          cast(aktualni as int) as is_current
        from attached"""),
    "trip_carrier": _check("""
        select md5(concat_ws(chr(31), t.feed_id, t.cislo_linka, 1, t.cislo_spoj)) as trip_id,
          md5(concat_ws(chr(31), c.ico, c.jmeno, c.sidlo)) as carrier_id
        from trip_src t join line_src l on l.feed_id=t.feed_id and l.cislo_linka=t.cislo_linka
        left join altdop a on a.cislo_spoj=t.cislo_spoj
        join carrier_src c on c.feed_id=t.feed_id and c.ico=coalesce(a.ico, l.ico)"""),
    "gtfs_trips": _check(
        """
        select a.linka_id as route_id, svc.service_id, a.spoj_id as trip_id
        from attached a join svc on svc.trip=a.cislo_spoj where a.aktualni""",
        TRIPS_OF_ACCEPTED_LINES,
    ),
    "holidays": _check("""
        select cast(d as varchar) as day from hol where y in (select feed_id from trip_src)"""),
    "holidays_with_freedom_day": _check("""
        select cast(d as varchar) as day from hol where y in (select feed_id from trip_src)
        union select cast(make_date(feed_id,11,17) as varchar) from trip_src"""),
    "record_fields": """
        select cast(p_partkey as bigint) as line_no, 4 as n_fields,
          cast(p_partkey as varchar) as field_0,
          '"' || p_name || '", ' || p_brand as field_1, '' as field_2,
          p_type || chr(13) || chr(10) || ',' || p_name as field_3, '' as problem
        from part""",
    "call_layout": _check("""
        select cast(feed_id as varchar) as feed_id, cislo_linka as line_number,
          case when feed_id%5 in (2,3) then 1 else -1 end as line_discriminator,
          cast(cislo_spoj as bigint) as trip_number, cislo_tarifni as tariff_number,
          cast(cislo_zastavka as bigint) as stop_number, cast(km as int) as km,
          prijezd as arrival, odjezd as departure,
          case when feed_id%5=2 then 1 else 0 end as drops_untimed
        from call_src join trip_src using (cislo_spoj)
        where feed_id%5<>4 and not (cislo_spoj%17=0 and cislo_tarifni=1)
          and not (cislo_spoj%19=0 and cislo_tarifni=2)"""),
    "rejects": _check("""
        select cast(feed_id as varchar) as feed_id, 'calls' as "table",
          case when feed_id%5=4 then 'unknown version'
               else 'missing or malformed value' end as reason, count(*) as n_rows
        from call_src join trip_src using (cislo_spoj)
        where feed_id%5=4 or (cislo_spoj%17=0 and cislo_tarifni=1)
          or (cislo_spoj%19=0 and cislo_tarifni=2)
        group by 1, 2, 3"""),
    "fixed_code_dictionary": _check("""
        select distinct feed_id, 'k' || kod as code_id, kod as meaning
        from (select feed_id, unnest(string_split(kody, ',')) as kod from trip_src)
        where kod<>''"""),
    "holidays_class": _check("""
        select cast(platnost_od as varchar) as valid_from, cast(platnost_do as varchar) as valid_to,
          n_lines,
          coalesce(string_agg(t, ',' order by t) filter (where isodow(d)<7), '') as except_sunday,
          coalesce(string_agg(t, ',' order by t)
            filter (where isodow(d)<7 and week(d)%2=1), '') as odd_weeks,
          coalesce(string_agg(t, ',' order by t)
            filter (where isodow(d)<7 and week(d)%2=0), '') as even_weeks,
          coalesce(string_agg(t, ',' order by t) filter (where isodow(d)<6), '') as monday_to_friday,
          coalesce(string_agg(t, ',' order by t) filter (where isodow(d)=6), '') as on_saturday
        from (select platnost_od, platnost_do, count(*) as n_lines from line_src group by 1, 2)
        left join (select d, cast(d as varchar) as t from hol) h
          on h.d between platnost_od and platnost_do
        group by platnost_od, platnost_do, n_lines"""),
    "fixed_code_mask": _check(f"""
        select trip as trip_number, {_FLAGS}, x as on_working_days, p as on_holidays from fl"""),
    "time_codes": _check("""
        , texts as (select distinct cislo_spoj, typ || ':' || strftime(od,'%Y%m%d') || ':'
            || coalesce(strftime(do_,'%Y%m%d'),'') as kod from caskody)
        select t.cislo_spoj as trip_number, s.n as n_codes,
          string_agg(kod, ',' order by kod) as codes
        from texts t join code_stats s on s.trip=t.cislo_spoj group by 1, 2"""),
    "service_period": _check("""
        select trip as trip_number, cast(od as varchar) as period_from,
          cast(do_ as varchar) as period_to, cast(cal as int) as uses_calendar
        from per"""),
    "calendar_ranges": _day_sets("added1"),
    "calendar_also": _day_sets("added23"),
    "calendar_not": _day_sets("excluded4"),
    "calendar_parity": _day_sets("added58"),
    "calendar_holidays": _check("""
        select per.trip as trip_number,
          coalesce((select string_agg(cast(d as varchar), ',' order by d)
            from (select * from skipped except select * from excluded4) s
            where s.trip=per.trip), '') as skipped,
          coalesce((select string_agg(cast(d as varchar), ',' order by d)
            from (select * from gained except select * from added) g
            where g.trip=per.trip), '') as gained
        from per where cal"""),
    "calendar_services": _check(
        """
        select service_id, cast(cal as int) as uses_calendar,
          case when cal then cast(maska as int) end as mask,
          case when cal then cast(od as varchar) end as period_from,
          case when cal then cast(do_ as varchar) end as period_to,
          case when cal then x end as on_working_days, case when cal then p end as on_holidays,
          md5(jede_cisla) as runs_digest, md5(nejede_cisla) as runs_not_digest
        from svc_one""",
        TRIPS_OF_ACCEPTED_LINES,
    ),
    "calendar": _check(
        f"""
        select service_id, {_FLAGS}, strftime(od,'%Y%m%d') as start_date,
          strftime(do_,'%Y%m%d') as end_date
        from svc_one where cal""",
        TRIPS_OF_ACCEPTED_LINES,
    ),
    "calendar_dates": _check(
        """
        select service_id, strftime(d,'%Y%m%d') as date, 1 as exception_type
        from svc_one join run_days using (trip)
        union all
        select service_id, strftime(d,'%Y%m%d') as date, 2 as exception_type
        from svc_one join not_days using (trip)""",
        TRIPS_OF_ACCEPTED_LINES,
    ),
    "service_days": _check(
        """
        , weekly as (select trip, cast(d as date) as d from (
            select trip, unnest(generate_series(od, do_, interval 1 day)) as d
            from svc_one where cal)),
        days as (
          select w.trip, w.d from weekly w join wd on wd.trip=w.trip and wd.dow=isodow(w.d)
          except select * from not_days
          union select r.* from run_days r join svc_one using (trip))
        select service_id, count(*) as n_days, cast(min(d) as varchar) as first_day,
          cast(max(d) as varchar) as last_day
        from days join svc_one using (trip) group by 1""",
        TRIPS_OF_ACCEPTED_LINES,
    ),
    "terminus_flags": _check("""
        select cislo_spoj as trip_number, cislo_tarifni as tariff_number,
          case when pred is null then 'počáteční zastávka'
               when po is null then 'konečná zastávka' end as terminus
        from wide1"""),
    "timetable_wide": _check(
        """
        select cast(w.cislo_linka as int) as line_number, w.cislo_spoj as trip_number,
          w.cislo_tarifni as tariff_number, w.km, z.cislo_zastavka as stop_number,
          concat(z.obec,',',z.cast_obce,',',z.misto) as stop_name, w.nazev_linka as line_name,
          w.dopravce as carrier, w.cas as "time", cast(w.platnost_od as varchar) as valid_from,
          cast(w.konec as varchar) as valid_to,
          case when pred is null then 'počáteční zastávka'
               when po is null then 'konečná zastávka' end as terminus,
          case when cal then m1 end as monday, case when cal then m2 end as tuesday,
          case when cal then m3 end as wednesday, case when cal then m4 end as thursday,
          case when cal then m5 end as friday, case when cal then m6 end as saturday,
          case when cal then m7 end as sunday, case when cal then x end as working_days,
          case when cal then p end as holidays,
          case when cal then cast(svc.od as varchar) end as period_from,
          case when cal then cast(svc.do_ as varchar) end as period_to,
          nullif(jede,'') as also_runs, nullif(nejede,'') as does_not_run
        from wide1 w join stop_first z using (zastavka_id) join svc on svc.trip=w.cislo_spoj
        order by line_number, trip_number, w.km nulls last, "time" """,
        TRIPS_OF_ACCEPTED_LINES,
        "platnost_od <> konec",
    ),
}
