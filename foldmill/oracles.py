"""The registered queries again as SQL for another engine, written from the definitions, not from the Spark code.

For queries that train for many epochs it states what was trained on what and that it learned; ``train_history`` follows the numbers themselves.
"""

from __future__ import annotations

from foldmill import fixtures as fx
from foldmill import queries as q
from foldmill.operators.dense_net import BUCKETS, initial_weights
from foldmill.operators.model import HIDDEN
from foldmill.operators.tune import BATCH_SLICES

LOW, HIGH = fx.BAND_BORDERS

RAW = f"""
with ln as (
    select l_orderkey, sum(l_quantity) qty, max(l_discount) disc, cast(count(*) as double) n_lines,
           max(l_extendedprice) peak, sum(l_extendedprice) net
    from lineitem group by l_orderkey),
raw_samples as (
    select o.o_orderkey id, o.o_orderstatus label, o.o_totalprice price, c.c_acctbal bal, ln.qty, ln.disc,
           ln.n_lines, ln.peak, o.o_orderpriority prio, c.c_mktsegment seg,
           case when coalesce(net, 0) < {LOW} then '1-small' when coalesce(net, 0) < {HIGH} then '2-medium'
                else '3-large' end band
    from orders o left join customer c on o.o_custkey = c.c_custkey left join ln on ln.l_orderkey = o.o_orderkey),
samples as (select * replace (nullif(prio, '4-NOT SPECIFIED') as prio) from raw_samples)
"""
HASH = "md5(concat('42:', cast(id as string)))"
HASH32 = f"cast('0x' || substr({HASH}, 1, 8) as bigint)"
FOLDED = RAW + f", f as (select *, ntile(5) over (order by {HASH}, id) - 1 as fold from samples)"
COLUMNS = "id, label, price, bal, qty, disc, prio, seg"

ZERO = "cast(0 as double)"
ONE = "cast(1 as double)"


def rnd(expr: str, digits: int) -> str:
    return f"round({expr}, {digits}) + {ZERO}"


def flag(condition: str) -> str:
    return f"case when {condition} then {ONE} else {ZERO} end"


def _logit(j: int) -> str:
    """The given classifier's score of class ``j``."""
    plan, w = q.FIXED, [row[j] for row in q.FIXED_WEIGHTS]
    terms = [
        f"{w[i]} * (coalesce({c}, {plan.means[c]}) - {plan.means[c]}) / {plan.deviations[c]}" for i, c in enumerate(plan.numeric)
    ]
    at = len(plan.numeric)
    terms += [
        f"{w[at + i]} * {flag(f'coalesce(prio, {plan.fills['prio']!r}) = {v!r}')}" for i, v in enumerate(plan.vocabulary["prio"])
    ]
    return "cast(" + " + ".join(terms) + f" + {w[-1]} as double)"


def scored(source: str = "samples", head: str = RAW) -> str:
    kept = "id, label, price, bal, qty, disc, n_lines, prio, seg" + (", fold" if head == FOLDED else "")
    return head + f""", lg as (select {kept}, {_logit(0)} a, {_logit(1)} b, {_logit(2)} c from {source}),
    ex as (select *, exp(a) ea, exp(b) eb, exp(c) ec from lg),
    pr as (select *, ea/(ea+eb+ec) pf, eb/(ea+eb+ec) po, ec/(ea+eb+ec) pp from ex),
    sc as (select *, case when pf >= po and pf >= pp then 'F' when po >= pp then 'O' else 'P' end prediction,
           greatest(pf, po, pp) confidence, case label when 'F' then pf when 'O' then po else pp end p_true from pr)"""


FIXED_PRICE, FIXED_BAL = "price / 100000.0", "bal / 10000.0"
LOSS = "avg(-ln(greatest(p_true, cast(1e-7 as double))))"
HIT = f"avg({flag('prediction = label')})"
FOLD_METRICS = scored("f", FOLDED) + f""",
    per as (select fold, {HIT} test_accuracy, {LOSS} test_loss from sc group by fold),
    fm as (select fold, 'test_accuracy' metric, test_accuracy as value from per
           union all select fold, 'test_loss', test_loss from per)"""

STAMP = "timestamp '2024-01-02 03:04:05'"


def _describe() -> str:
    parts = []
    for c in ("price", "bal", "qty", "disc"):
        parts.append(
            f"select '{c}' column_name, count({c}) n, {rnd(f'avg({c})', 4)} mean, {rnd(f'stddev_samp({c})', 4)} sd, "
            f"min({c}) min_number, max({c}) max_number, cast(null as varchar) min_text, cast(null as varchar) max_text "
            "from samples"
        )
    for c in ("label", "prio", "seg"):
        parts.append(
            f"select '{c}', count({c}), cast(null as double), cast(null as double), cast(null as double), "
            f"cast(null as double), min({c}), max({c}) from samples"
        )
    return RAW + " union all ".join(parts)


def _validate() -> str:
    parts = [
        f"select '{c}' column_name, true present, count(*) n_rows, count(*) - count({c}) n_null from samples"
        for c in ("price", "bal", "qty", "disc", "prio", "seg")
    ]
    parts += [f"select '{c}', false, count(*), cast(null as bigint) from samples" for c in ("sex", "island")]
    return RAW + " union all ".join(parts)


CATEGORIES = " union all ".join(
    f"select '{c}' column_name, {c} as value, row_number() over (order by {c}) - 1 idx "
    f"from (select distinct {c} from samples where {c} is not null)"
    for c in ("label", "prio", "seg")
)
PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
SEGMENTS = "(select array_agg(distinct seg order by seg) from {})"
PRIO_LIST = "(select array_agg(distinct prio order by prio) filter (where prio is not null) from {})"

NUMBER_STATS = """, st as (select {}, (select prio from {source} where prio is not null group by prio
    order by count(*) desc, prio limit 1) mode_prio from {source})"""


def _assemble(source: str, kept: str, train: str, imputed: bool, drop_first: bool) -> str:
    """Scaled numeric columns, then one 0/1 column per category in sorted order; statistics from ``train``."""
    numeric = ["price", "bal", "qty", "disc"]
    means = ", ".join(f"avg({c}) mu_{c}" for c in numeric)
    sums = ", ".join(
        f"sqrt(sum(power(coalesce({c}, mu_{c}) - mu_{c}, 2)) / count(*)) sd_{c}" for c in numeric
    )
    fills = "(select prio from tr where prio is not null group by prio order by count(*) desc, prio limit 1)"
    slots = [
        rnd(f"(coalesce(s.{c}, mu_{c}) - mu_{c}) / case when sd_{c} = 0 then 1 else sd_{c} end", 6) for c in numeric
    ]
    prio = "coalesce(s.prio, mode_prio)" if imputed else "s.prio"
    first = 2 if drop_first else 1
    slots += [flag(f"{prio} = prios[{i}]") for i in range(first, 5)]
    slots += [flag(f"s.seg = segs[{i}]") for i in range(first, 6)]
    listed = ", ".join(f"{e} slot_{i:02d}" for i, e in enumerate(slots))
    return f""", tr as ({train}),
    mu as (select {means} from tr), sd as (select {sums} from tr, mu),
    voc as (select {fills} mode_prio, {PRIO_LIST.format('tr')} prios, {SEGMENTS.format('tr')} segs)
    select {kept}, {listed} from {source} s, mu, sd, voc"""


PARTS = f""", r as (select *, row_number() over (order by {HASH}, id) - 1 r, count(*) over () n from base),
    k as (select *, n - (3*n + 9)//10 tr, (3*n + 9)//10 - ((3*n + 9)//10 + 1)//2 va from r),
    parts as (select * exclude (r, n, tr, va),
              case when r < tr then 'train' when r < tr + va then 'val' else 'test' end part from k)"""
COMPLETE = ", base as (select {} from samples where price is not null and bal is not null and qty is not null " \
           "and disc is not null and prio is not null and seg is not null)".format(COLUMNS)

LEARNED = ", base as (select id, band, qty, n_lines, peak, bal, prio, seg from samples where band is not null and qty is not null and " \
          "n_lines is not null and peak is not null and bal is not null and prio is not null and seg is not null)"


def _trained(columns: str) -> str:
    """One row about a network that learned from all but the last fifth of the seeded order."""
    return RAW + f""", r as (select *, row_number() over (order by {HASH}, id) - 1 r, count(*) over () n from samples),
    m as (select *, r >= (n * 8) // 10 held from r),
    c as (select any_value(n) n, count(*) filter (where not held) n_train, count(*) filter (where held) n_test,
          4 + count(distinct prio) filter (where not held) + count(distinct seg) filter (where not held) n_features,
          4 + count(distinct prio) + count(distinct seg) n_all_features from m),
    w as (select *, (n_features + 1) * {HIDDEN[0]} + {(HIDDEN[0] + 1) * HIDDEN[1] + (HIDDEN[1] + 1) * 3} n_weights from c)
    select {columns} from w"""


# Train statistics of each fold vf straight from its train rows.
FOLD_STATS = """, k as (select distinct fold vf from f),
    mm as (select vf, avg(price) mu_price, avg(qty) mu_qty from k join f on f.fold <> k.vf group by vf),
    ss as (select mm.vf, sqrt(avg(power(price - mu_price, 2))) sd_price,
                  sqrt(avg(power(coalesce(qty, mu_qty) - mu_qty, 2))) sd_qty
           from mm join f on f.fold <> mm.vf group by mm.vf),
    pc as (select vf, prio, count(*) c from k join f on f.fold <> k.vf where prio is not null group by vf, prio),
    md as (select vf, prio mode_prio from (select *, row_number() over (partition by vf order by c desc, prio) rn from pc)
           where rn = 1),
    fs as (select * from mm join ss using (vf) join md using (vf))"""
PRICE_SCALED = rnd("(price - mu_price) / case when sd_price = 0 then 1 else sd_price end", 6)
QTY_SCALED = rnd("(coalesce(qty, mu_qty) - mu_qty) / case when sd_qty = 0 then 1 else sd_qty end", 6)
FOLD_SLOTS = f"{PRICE_SCALED} slot_00, {QTY_SCALED} slot_01, " + ", ".join(
    f"{flag(f'coalesce(prio, mode_prio) = {p!r}')} slot_{i + 2:02d}" for i, p in enumerate(PRIOS)
)
FOLD_ROLE = "case when f.fold = vf then 'test' else 'train' end role, case label when 'F' then cast(0 as bigint) " \
            "when 'O' then 1 else 2 end target"


def _early_stop() -> str:
    """Per fold: losses of ten steps, then the stop rule by looking for each step's last improvement."""
    steps = []
    for step in range(10):
        slope = (step - 4) / 10.0
        a, b = f"exp({FIXED_PRICE} * ({slope}))", f"exp({FIXED_BAL} * ({slope}))"
        true = f"case label when 'F' then {a} when 'O' then {b} else {ONE} end / ({a} + {b} + {ONE})"
        steps.append(
            f"select fold, cast({step} as bigint) step, avg(-ln(greatest({true}, cast(1e-7 as double)))) val_loss "
            "from f group by fold"
        )
    return FOLDED + f""", h as ({' union all '.join(steps)}),
    imp as (select a.fold, a.step from h a where not exists
            (select 1 from h b where b.fold = a.fold and b.step < a.step and b.val_loss <= a.val_loss)),
    last as (select h.fold, h.step, (select max(i.step) from imp i where i.fold = h.fold and i.step <= h.step) li from h),
    stop as (select fold, coalesce(min(case when step - li >= 3 then step end), max(step)) stop_step from last
             group by fold)
    select s.fold, (select max(i.step) from imp i where i.fold = s.fold and i.step <= s.stop_step) best_step,
           s.stop_step, {rnd('min(h.val_loss)', 5)} best_loss
    from stop s join h on h.fold = s.fold and h.step <= s.stop_step group by s.fold, s.stop_step"""


def _trial_results() -> str:
    parts = []
    for trial in range(3):
        for execution in range(2):
            slope = (trial + 1) * 0.5 - execution * 0.25
            a, b, c = f"exp({FIXED_PRICE} * {slope})", f"exp({FIXED_BAL})", f"exp(cast({slope} as double))"
            true = f"case label when 'F' then {a} when 'O' then {b} else {c} end"
            p = f"({true}) / ({a} + {b} + {c})"
            hit = flag(f"({true}) = greatest({a}, {b}, {c})")
            for name, value in (("val_accuracy", hit), ("val_loss", f"-ln(greatest({p}, cast(1e-7 as double)))")):
                parts.append(
                    f"select cast({trial} as bigint) trial, {execution} execution, '{name}' metric, avg({value}) as value "
                    "from parts where part = 'val'"
                )
    return RAW + ", base as (select * from samples)" + PARTS + f""",
    res as ({' union all '.join(parts)}),
    red as (select trial, metric, case when metric = 'val_loss' then min(value) else max(value) end as value
            from res group by trial, metric)"""


def _u(name: str) -> str:
    return f"cast('0x' || substr(md5(concat('42:{name}:', cast(t as string))), 1, 8) as bigint)"


def _trial_grid() -> str:
    return RAW + COMPLETE + PARTS + f""",
    n as (select count(*) train_rows from parts where part = 'train'),
    g as (select cast(t as bigint) trial, {rnd(f"exp(ln(1e-4) + ({_u('lr')} / 4294967296.0) * (ln(1e-2) - ln(1e-4)))", 8)}
          learning_rate, cast(32 * (1 + {_u('u')} % 4) as bigint) units,
          case {_u('d')} % 3 when 0 then cast(0.1 as double) when 1 then cast(0.2 as double)
               else cast(0.3 as double) end dropout_rate,
          cast(32 * (1 + {_u('b')} % 2) as bigint) batch_size, cast(10 + 5 * ({_u('e')} % 3) as bigint) epochs
          from range(5) z(t))
    select g.*, train_rows, (train_rows + batch_size - 1) // batch_size updates_per_epoch,
           ((train_rows + batch_size - 1) // batch_size) * epochs updates from g, n"""


def _descent(epochs: int, rate: float, slices: int = 1, dropout: float = 0.0) -> str:
    """Gradient descent on the dense network, each update spelled out as sums over the train rows of its slice."""
    inputs = q.HISTORY_NUMERIC
    layers = [len(inputs), *HIDDEN, 3]
    start = initial_weights(layers, 42)
    n0, n1, n2, n3 = layers
    at1 = 0
    b1 = at1 + n0 * n1
    at2 = b1 + n1
    b2 = at2 + n1 * n2
    at3 = b2 + n2
    b3 = at3 + n2 * n3

    def dense(source, size_in, size_out, at, bias):
        return [
            " + ".join([f"w{bias + j}"] + [f"{source}{i}*w{at + i * size_out + j}" for i in range(size_in)])
            for j in range(size_out)
        ]

    def kept(unit: int) -> str:
        return f" * m{unit}" if dropout else ""

    def forward(name: str, source: str, weights: str, masked: bool) -> str:
        """Tables h1, h2, z, p of this name: both hidden layers, raised scores, probabilities."""
        mask = kept if masked else lambda unit: ""
        hidden1 = ", ".join(f"greatest({z}, {ZERO}){mask(j)} a{j}" for j, z in enumerate(dense("x", n0, n1, at1, b1)))
        hidden2 = ", ".join(f"greatest({z}, {ZERO}){mask(n1 + j)} c{j}" for j, z in enumerate(dense("a", n1, n2, at2, b2)))
        scores = ", ".join(f"exp({z}) e{j}" for j, z in enumerate(dense("c", n2, n3, at3, b3)))
        total = " + ".join(f"e{j}" for j in range(n3))
        probs = ", ".join(f"e{j} / ({total}) p{j}" for j in range(n3))
        return f""",
    h1_{name} as (select *, {hidden1} from ({source}), {weights}),
    h2_{name} as (select *, {hidden2} from h1_{name}),
    z_{name} as (select *, {scores} from h2_{name}),
    p_{name} as (select *, {probs} from z_{name}),
    s_{name} as materialized (select count(*) n, sum(-ln(greatest(case y when 0 then p0 when 1 then p1 else p2 end,
        cast(1e-7 as double)))) loss, sum({flag('y = case when p0 >= p1 and p0 >= p2 then 0 when p1 >= p2 then 1 else 2 end')})
        hits from p_{name})"""

    means = ", ".join(f"avg({c}) mu{i}" for i, c in enumerate(inputs))
    devs = ", ".join(f"sqrt(avg(power(coalesce({c}, mu{i}) - mu{i}, 2))) sd{i}" for i, c in enumerate(inputs))
    xs = ", ".join(f"(coalesce({c}, mu{i}) - mu{i}) / sd{i} x{i}" for i, c in enumerate(inputs))
    sql = RAW + f""",
    r as (select *, row_number() over (order by {HASH}, id) - 1 r, count(*) over () n from samples),
    b0 as (select *, r >= (n * 8) // 10 held, case band when '1-small' then 0 when '2-medium' then 1 else 2 end y from r),
    mu as (select {means} from b0 where not held),
    sd as (select {devs} from b0, mu where not held),
    base as materialized (select id, y, held, cast('0x' || substr(md5(concat('bucket:', cast(id as string))), 1, 8) as bigint) % {BUCKETS} bucket, {xs} from b0, mu, sd),
    w_0 as materialized (select {', '.join(f'cast({float(w)!r} as double) w{i}' for i, w in enumerate(start))})"""
    delta3 = ", ".join(f"p{j} - {flag(f'y = {j}')} t{j}" for j in range(n3))
    back2 = ", ".join(
        f"case when c{i} > 0 then ({' + '.join(f't{j}*w{at3 + i * n3 + j}' for j in range(n3))}){kept(n1 + i)} else {ZERO} end u{i}"
        for i in range(n2)
    )
    back1 = ", ".join(
        f"case when a{i} > 0 then ({' + '.join(f'u{j}*w{at2 + i * n2 + j}' for j in range(n2))}){kept(i)} else {ZERO} end v{i}"
        for i in range(n1)
    )
    grads = {}
    for i in range(n0):
        grads |= {at1 + i * n1 + j: f"x{i}*v{j}" for j in range(n1)}
    grads |= {b1 + j: f"v{j}" for j in range(n1)}
    for i in range(n1):
        grads |= {at2 + i * n2 + j: f"a{i}*u{j}" for j in range(n2)}
    grads |= {b2 + j: f"u{j}" for j in range(n2)}
    for i in range(n2):
        grads |= {at3 + i * n3 + j: f"c{i}*t{j}" for j in range(n3)}
    grads |= {b3 + j: f"t{j}" for j in range(n3)}
    updates = ", ".join(f"any_value(w{k}) - {rate} * avg({grads[k]}) w{k}" for k in range(b3 + n3))
    for k in range(epochs * slices):
        epoch, step = divmod(k, slices)
        drawn = "".join(
            f", case when cast('0x' || substr(md5(concat_ws(':', '42', '{epoch}', cast(id as string), '{u // 8}')), {4 * (u % 8) + 1}, 4) as bigint) "
            f">= {dropout} * 65536 then 1 / (1 - cast({dropout} as double)) else {ZERO} end m{u}"
            for u in range(n1 + n2 if dropout else 0)
        )
        if step == 0:
            sql += f""",
    d_{epoch} as (select b, ((row_number() over (order by cast('0x' || substr(md5(concat('42:slice{epoch}:', cast(b as string))), 1, 8) as bigint), b) - 1)
        * {slices}) // {BUCKETS} part from range({BUCKETS}) z(b))"""
        source = f"select base.*{drawn} from base join d_{epoch} on bucket = b where not held and part = {step}"
        sql += forward(str(k), source, f"w_{k}", True) + f""",
    t_{k} as (select *, {delta3} from p_{k}),
    u_{k} as (select *, {back2} from t_{k}),
    v_{k} as (select *, {back1} from u_{k}),
    w_{k + 1} as materialized (select {updates} from v_{k})"""
    for epoch in range(epochs):
        sql += forward(f"held{epoch}", "select * from base where held", f"w_{(epoch + 1) * slices}", False)
    rows = []
    for e in range(epochs):
        seen = " union all ".join(f"select * from s_{k}" for k in range(e * slices, (e + 1) * slices))
        rows.append(
            f"select cast({e} as bigint) step, {rnd('a.loss / a.n', 5)} train_loss, {rnd('a.hits / a.n', 5)} train_accuracy, "
            f"{rnd('b.loss / b.n', 5)} val_loss, {rnd('b.hits / b.n', 5)} val_accuracy "
            f"from (select sum(n) n, sum(loss) loss, sum(hits) hits from ({seen})) a, s_held{e} b"
        )
    return sql + " " + " union all ".join(rows)


LISTS = FOLDED + """, pieces as (select fold home,
        cast('0x' || substr(md5(concat('42:piece:', cast(id as string))), 1, 8) as bigint) %
        (select greatest(1, (count(*) + 4999) // 5000) from samples) piece, list(id order by id) ids
        from f group by 1, 2),
    lists as (select k.fold, case when k.fold = home then 'test' else 'train' end role, home source_fold, piece, ids
              from pieces cross join (select distinct fold from f) k)"""

CLERKS = """with n as (select o_orderkey id, c_name as name, o_orderpriority prio from orders left join customer on o_custkey = c_custkey)"""

ORACLES: dict[str, str] = {
    # reading and writing
    "csv_declared_schema": RAW + f"select {COLUMNS} from samples",
    "csv_inferred_schema": RAW + """select id, label, price, qty, cast(n_lines as bigint) n_lines, case when seg <> 'BUILDING' then true end flag,
        cast(date '2020-01-01' + cast(id % 1000 as int) as date) as day, case when label = 'P' then 'unknown' else cast(id as varchar) end mixed,
        cast(null as varchar) nothing from raw_samples""",
    "table_replace": RAW + f"select {COLUMNS}, (select count(*) from samples) n_before from samples where label <> 'F'",
    "table_truncated": RAW + f"select count(*) n_before, cast(0 as bigint) n_after, '{','.join(q.SAMPLE_COLUMNS)}' as columns from samples",
    "table_by_path": RAW + f"select {COLUMNS} from samples",
    "table_by_name": RAW + f"select {COLUMNS} from samples",
    "append_merge_schema": RAW + "select id, label, qty, case when label <> 'F' then disc end disc from samples",
    "snapshot_json": RAW + f"select {COLUMNS} from samples",
    # projections, null handling, schema
    "sentinel_to_null": RAW + "select id, case when prio <> '4-NOT SPECIFIED' then prio end prio from raw_samples",
    "drop_missing": RAW + f"select {COLUMNS} from samples where qty is not null and disc is not null and prio is not null",
    "fill_constant": RAW + "select id, coalesce(prio, 'NA') prio, coalesce(seg, 'NA') seg from samples",
    "features_label_split": RAW + "select id, price, bal, qty, disc, prio, seg, cast(null as varchar) label from samples union all "
    "select null, null, null, null, null, null, null, label from samples",
    "select_by_type": RAW + "select id, label, price, bal, qty, disc from samples",
    "validate_schema": _validate(),
    "conform_schema": RAW + "select id, qty, prio, seg from samples",
    "fold_train_rows": FOLDED + "select id, fold from f where fold <> 2",
    "fold_test_rows": FOLDED + "select id, fold from f where fold = 2",
    "stamp_batch": RAW + f"select id, {STAMP} prediction_time from samples",
    "decode_ids": FOLDED + "select k.fold, case when k.fold = f.fold then 'test' else 'train' end role, f.id "
    "from f cross join (select distinct fold from f) k",
    # joins
    "rows_by_id_list": RAW + "select id, label, price from samples where exists "
    "(select 1 from lineitem where l_orderkey = id and l_quantity > 45)",
    "attach_predictions": scored() + f"select id, price, seg, prediction, {rnd('confidence', 6)} confidence from sc",
    "index_to_label": RAW + f"select id, {HASH32} % 4 class_index, ['F', 'O', 'P'][{HASH32} % 4 + 1] prediction from samples",
    "join_folds": FOLDED + "select id, seg, fold from f",
    # aggregates
    "row_count": RAW + "select count(*) n_rows from samples",
    "describe": _describe(),
    "categories": RAW + CATEGORIES,
    "eval_accuracy_logloss": scored() + f"select count(*) n_rows, {rnd(HIT, 6)} accuracy, {rnd(LOSS, 5)} loss from sc",
    "majority_share": RAW + f"select {rnd('max(n) / sum(n)', 6)} majority_share "
    "from (select label, count(*) n from samples group by label)",
    "confusion": scored() + "select label, prediction, count(*) n from sc group by 1, 2",
    "cv_average": FOLD_METRICS + f"select metric, {rnd('avg(value)', 6)} as value, count(*) n_folds from fm group by metric",
    "quality_gate": FOLD_METRICS + f"select metric, {rnd('avg(value)', 6)} as value, cast(0.7 as double) threshold, "
    "avg(value) >= 0.7 passed from fm where metric = 'test_accuracy' group by metric",
    # splits and samples
    "kfold_exact": FOLDED + "select id, fold from f",
    "kfold_hash": RAW + f"select id, {HASH32} % 5 fold from samples",
    "fold_id_lists": LISTS + " select fold, role, source_fold, piece, cast(to_json(ids) as varchar) ids from lists",
    "split_70_15_15": RAW + ", base as (select * from samples)" + PARTS + "select id, part from parts",
    "holdout_tail": RAW + f"select id, row_number() over (order by {HASH}, id) - 1 >= (count(*) over () * 8) // 10 is_holdout "
    "from samples",
    "stable_shuffle": RAW + f"select id, label, row_number() over (order by {HASH}, id) - 1 as position from samples",
    "sample_n": RAW + f"select id, label, price from samples order by {HASH}, id limit 5",
    "row_key": """with c as (select l_orderkey, l_linenumber, l_returnflag, row_number() over (
            partition by l_orderkey, l_linenumber, l_returnflag) - 1 as copy from lineitem)
        select concat(md5(concat('{"l_orderkey":', l_orderkey, ',"l_linenumber":', l_linenumber, ',"l_returnflag":"',
            l_returnflag, '"}')), ':', copy) row_key, l_orderkey, l_linenumber, l_returnflag from c""",
    # features
    "target_ordinal": RAW + "select id, dense_rank() over (order by label) - 1 target from samples",
    "target_onehot": RAW + "select id, " + ", ".join(f"{flag(f'label = {c!r}')} label_{c}" for c in fx.CLASSES) + " from samples",
    "impute_mean": RAW + f"select id, {rnd('coalesce(qty, avg(qty) over ())', 4)} qty, "
    f"{rnd('coalesce(disc, avg(disc) over ())', 4)} disc from samples",
    "impute_mode": RAW + "select id, coalesce(prio, (select prio from samples where prio is not null group by prio "
    "order by count(*) desc, prio limit 1)) prio from samples",
    "standard_scale": RAW + f"select id, {rnd('(price - avg(price) over ()) / stddev_pop(price) over ()', 6)} price_scaled, "
    f"{rnd('(bal - avg(bal) over ()) / stddev_pop(bal) over ()', 6)} bal_scaled from samples",
    "onehot": RAW + "select id, " + ", ".join(f"{flag(f'prio = {p!r}')} prio_{i}" for i, p in enumerate(PRIOS)) + " from samples",
    "onehot_array": RAW + f", voc as (select {PRIO_LIST.format('samples')} v) select id, cast(to_json(list_transform(v, "
    f"lambda p: case when prio = p then {ONE} else {ZERO} end)) as varchar) slots from samples, voc",
    "onehot_drop_first": RAW + f", voc as (select {SEGMENTS.format('samples')} v) select id, "
    + ", ".join(f"{flag(f'seg = v[{i + 1}]')} seg_{i}" for i in range(1, 5)) + " from samples, voc",
    "assemble_features": RAW + _assemble("samples", "id", "select * from samples", True, False),
    "assemble_drop_first": RAW + COMPLETE + PARTS
    + _assemble("parts", "id, part", "select * from parts where part = 'train'", False, True),
    "feature_names": RAW + ", c as (" + CATEGORIES + """), n as (select i part, cast(0 as bigint) idx, ['price', 'bal', 'qty', 'disc'][i + 1] as name
        from range(4) z(i) union all select case column_name when 'prio' then 4 else 5 end, idx, concat(column_name, '_', value) from c
        where column_name <> 'label')
        select row_number() over (order by part, idx) - 1 place, name from n""",
    "fold_fit_stats": FOLDED + ", k as (select distinct fold vf from f) " + " union all ".join(
        f"select vf fold, '{c}' column_name, cast(count(*) as bigint) n_rows, cast(count({c}) as bigint) n, "
        f"{rnd(f'avg({c})', 4)} mu, {rnd(f'stddev_pop({c})', 4)} sd from k join f on f.fold <> k.vf group by vf"
        for c in ("price", "qty")
    ),
    "exact_moments": FOLDED + ", k as (select distinct fold vf from f), " + "s as (" + " union all ".join(
        f"select vf fold, '{c}' column_name, cast(count(*) as bigint) n_rows, cast(count({c}) as bigint) n, sum(cast({c} as hugeint)) t, "
        f"sum(cast({c} as hugeint) * cast({c} as hugeint)) q from k join f on f.fold <> k.vf group by vf"
        for c in ("qty", "n_lines")
    ) + ") select fold, column_name, n_rows, n, cast(t as double) / n mu, cast(n * q - t * t as double) / n m2 from s",
    "exact_totals": RAW + " union all ".join(
        f"select '{c}' column_name, cast(count(*) as bigint) n_rows, cast(count({c}) as bigint) n, "
        f"cast(sum(cast({c} * 1152921504606846976 as hugeint)) as varchar) units from samples"
        for c in ("price", "bal", "disc", "peak")
    ),
    "fold_transform": FOLDED + FOLD_STATS + f"select id, fold, {PRICE_SCALED} price_scaled, {QTY_SCALED} qty_scaled, "
    "coalesce(prio, mode_prio) prio_filled from f join fs on fs.vf = f.fold",
    "transform_fold": FOLDED + FOLD_STATS + f"select id, {FOLD_ROLE}, {FOLD_SLOTS} from f cross join fs where vf = 2",
    "folds_partitioned": FOLDED + FOLD_STATS + f"select vf fold, {FOLD_ROLE}, id, {FOLD_SLOTS} from f cross join fs",
    "dictionary_codes": CLERKS + """, f as (select id, name, cast('0x' || substr(md5(concat('42:', cast(id as string))), 1, 8) as bigint) % 5 fold from n),
        w as (select name, dense_rank() over (order by name) - 1 code from (select distinct name from n where name is not null)),
        k as (select k.fold, f.name from range(5) k(fold) join f on f.fold <> k.fold where name is not null group by all),
        d as (select fold, name, dense_rank() over (partition by fold order by name) - 1 code from k)
        select id, f.fold, case when f.name is null then -2 else w.code end code,
               case when f.name is null then -2 else coalesce(d.code, -1) end code_in_fold
        from f left join w using (name) left join d on d.fold = f.fold and d.name = f.name""",
    "dictionary_onehot": CLERKS + """, a as (select name, dense_rank() over (order by name) - 2 place from (select distinct name from n where name is not null)),
        p as (select prio, dense_rank() over (order by prio) - 2 place from (select distinct prio from n where prio is not null)),
        m as (select (select name from n where name is not null group by name order by count(*) desc, name limit 1) name,
                     (select prio from n where prio is not null group by prio order by count(*) desc, prio limit 1) prio,
                     (select count(*) - 1 from a) names, (select count(*) - 1 from p) prios),
        s as (select n.id, names + prios size, list_filter([a.place, case when p.place >= 0 then names + p.place else -1 end], lambda x: x >= 0) slots
              from n, m join a on a.name = coalesce(n.name, m.name) join p on p.prio = coalesce(n.prio, m.prio))
        select id, size, cast(to_json(slots) as varchar) slots, cast(len(slots) as double) total from s""",
    # models
    "train_history": _descent(q.HISTORY_EPOCHS, q.HISTORY_RATE),
    "train_resumed": _descent(q.HISTORY_EPOCHS, q.HISTORY_RATE),
    "train_slices": _descent(q.SLICED["epochs"], q.SLICED["rate"], q.SLICED["slices"]),
    "train_dropout": _descent(q.DROPPED["epochs"], q.DROPPED["rate"], q.DROPPED["slices"], q.DROPPED["dropout"]),
    "early_stop_epoch": _early_stop(),
    "score_batch": scored() + f"select id, prediction, {rnd('confidence', 6)} confidence, {STAMP} prediction_time from sc",
    "capture_predictions": scored() + f"select id, price, bal, qty, prio, seg, prediction, {rnd('confidence', 6)} confidence, "
    f"{STAMP} prediction_time, case when label = 'P' then cast(cast(n_lines as int) as varchar) end n_lines from sc",
    "capture_once": scored() + f"select id, price, bal, qty, prio, seg, prediction, {rnd('confidence', 6)} confidence, {STAMP} prediction_time from sc",
    "prediction_report": scored() + f"select id, label, prediction, {rnd('confidence', 6)} confidence from sc "
    f"order by {HASH}, id limit 5",
    "registry_round_trip": scored() + f"""select cast(2 as bigint) as version, 'run-3' run_id, '{','.join(fx.CLASSES)}' target_classes,
        '{','.join(q.FIXED.names())}' feature_names, prediction, count(*) n from sc group by prediction""",
    "mlp_fit": _trained("n_train, n_test, n_features, n_weights, true beats_majority"),
    "train_minibatch": _trained("n_train, n_test, n_features, n_weights, cast(5 as bigint) epochs, cast(40 as bigint) updates, true beats_majority, true beats_whole_table"),
    "early_stop_fit": _trained("n_test, true stopped_early, true kept_best_epoch, true after_patience, true weights_restored"),
    "cv_metrics": FOLDED + "select fold, count(*) n_test, cast(50 as bigint) epochs, true beats_majority from f group by fold",
    "final_model": _trained("cast(1 as bigint) as version, n_all_features n_features, n_train, n_test n_holdout, n n_scored, true beats_majority"),
    # search
    "trial_grid": _trial_grid(),
    "trial_reduce": _trial_results() + f"select trial, metric, {rnd('value', 6)} as value from red",
    "best_trial": _trial_results() + f"select trial, {rnd('value', 6)} as value from red where metric = 'val_accuracy' "
    "order by red.value desc, trial limit 1",
    "tune_trials": f"""select cast(t as bigint) trial, cast(0 as bigint) execution, cast(4 as bigint) n_metrics, true in_range,
        cast(32 * (1 + {_u('u')} % 4) as bigint) units, cast(10 + 5 * ({_u('e')} % 3) as bigint) epochs,
        {BATCH_SLICES} // cast(32 * (1 + {_u('b')} % 2) as bigint) updates_per_epoch, true loss_falls from range(5) z(t)""",
    "tune_winner": RAW + LEARNED + PARTS + """, tr as (select * from parts where part = 'train')
        select (select count(*) from parts where part = 'test') n_test,
        4 + (select count(distinct prio) - 1 from tr) + (select count(distinct seg) - 1 from tr) n_features,
        true is_best, true own_units, true within_epochs, true beats_majority""",
    # run records and registry
    "run_params": RAW + ", c as (" + CATEGORIES + f"""), p as (select 'n_samples' as key, cast(count(*) as varchar) str from samples
        union all select concat('n_', column_name), cast(count(*) as varchar) from c group by column_name)
        select 'run-1' run_id, cast(null as varchar) parent_run_id, 'start' run_name, 'param' kind, key,
        cast(null as bigint) step, cast(null as double) num, str, {STAMP} ts from p""",
    "run_metrics": FOLD_METRICS + f"""select concat('cv-', fold) run_id, 'cv' parent_run_id,
        concat('cross-validation-cv-', fold) run_name, 'metric' kind, metric as key, fold step, {rnd('value', 6)} num,
        cast(null as varchar) str, {STAMP} ts from fm""",
    "run_rollup": FOLD_METRICS + f"""select 'cv' parent_run_id, 'cross-validation' parent_name, metric as key,
        {rnd('avg(value)', 6)} avg_num, count(*) n_children from fm group by metric""",
    "run_tree": FOLD_METRICS + f""", pc as (select fold, label, {HIT} accuracy from sc group by all),
        runs as (select 'job' run_id, cast(null as varchar) parent, 'job' as name union all select 'cv', 'job', 'cross-validation'
            union all select distinct concat('cv-', fold), 'cv', concat('cross-validation-cv-', fold) from per
            union all select concat('cv-', fold, '-', label), concat('cv-', fold), concat('class-', label) from pc),
        metrics as (select concat('cv-', fold) run_id, metric as key, value as num from fm
            union all select concat('cv-', fold, '-', label), 'class_accuracy', accuracy from pc),
        tree as (with recursive t as (
            select run_id, run_id root_id, cast(0 as bigint) depth, name as path, [run_id] above from runs where parent is null
            union all select c.run_id, t.root_id, t.depth + 1, concat(t.path, '/', c.name), list_append(t.above, c.run_id) from t join runs c on c.parent = t.run_id)
            select * from t),
        below as (select anc, key, avg(num) avg_num, count(*) n_runs from (select run_id, unnest(above) anc from tree) join metrics using (run_id) group by all)
        select run_id, root_id, depth, path, key, {rnd('avg_num', 6)} avg_num, n_runs from tree left join below on anc = run_id""",
    "registry_latest": RAW + """, v as (select *, row_number() over (partition by seg order by id desc) rn from samples)
        select seg as name, id as version, concat('models/', seg, '/', id) as path, concat('run-', label) run_id from v where rn = 1""",
}
