"""DuckDB SQL giving the same rows as the registered queries.

Decimal means are computed on whole pence, because DuckDB averages decimals as doubles.
"""

from __future__ import annotations

from stacklore.operators.quality import AcceptedValues, ExpressionIsTrue, NotNull, Relationships, Unique
from stacklore.plans import answer as answers
from stacklore.plans.suite import BOOK_SUITE
from stacklore.workload.tables import CARDS_PER_PAGE, SHELVES, SHOP

_RATING = "case p_size % 5 when 0 then 'One' when 1 then 'Two' when 2 then 'Three' when 3 then 'Four' else 'Five' end"
_PRICE = "'£' || cast(cast(round((p_retailprice - 900) / 2, 2) as decimal(10,2)) as varchar)"
_URL = (
    "case when p_size = 50 then 'media/p_' || p_partkey "
    "else 'catalogue/p_' || p_partkey || '/index.html' end"
)
_LATEST = "qualify row_number() over (partition by {keys} order by extracted_at desc nulls first, {rest}) = 1"


def _latest(keys: str, rest: str) -> str:
    return _LATEST.format(keys=keys, rest=", ".join(f"{c} asc nulls last" for c in rest.split()))


def _mean(column: str, weight: int = 1) -> str:
    """Mean of a decimal (weight 1: two places) or whole number, half-up at two places."""
    units = f"cast({column} * 100 as hugeint)"
    return f"((2 * sum({units}) + count({column})) // (2 * count({column}))) / 100.0"


_CTE = {
    "raw_books": f"""
        select p_name || ' & ' || p_brand || ' #' || p_partkey as product_name,
               case when scrape = 1 then '£0.00' else {_PRICE} end as price,
               {_RATING} as rating_word,
               cast(p_partkey % {SHELVES} as integer) as category_id,
               {_URL} as book_url,
               timestamp '2024-01-01 00:00:00' + to_days(p_size - scrape) as extracted_at
        from part, (values (0), (1)) s(scrape)""",
    "raw_categories": """
        select n_nationkey as category_id,
               case when scrape = 1 then 'old name' else '  ' || n_name || ' ' end as category_name,
               timestamp '2024-01-02 00:00:00' - to_days(scrape) as extracted_at
        from nation, (values (0), (1)) s(scrape)""",
    "raw_inventory": """
        select 'catalogue/p_' || l_partkey || '/index.html' as book_url,
               'upc' || l_partkey as upc,
               cast(l_quantity as integer) % 8 as num_in_stock,
               l_linenumber as num_reviews,
               text as description,
               l_shipdate as extracted_at
        from lineitem left join documents on l_partkey = doc_id""",
    "stg_books": f"""
        select product_name as book_title,
               cast(replace(price, '£', '') as decimal(10,2)) as price_gbp,
               rating_word,
               case rating_word when 'One' then 1 when 'Two' then 2 when 'Three' then 3
                                when 'Four' then 4 when 'Five' then 5 end as rating_stars,
               category_id, book_url, extracted_at
        from (select * from raw_books {_latest('book_url', 'product_name price rating_word category_id')})""",
    "stg_categories": f"""
        select category_id, trim(category_name) as category_name, extracted_at
        from (select * from raw_categories {_latest('category_id', 'category_name')})""",
    "stg_inventory": f"""
        select book_url, upper(upc) as upc, num_in_stock, num_reviews,
               nullif(trim(description), '') as description, extracted_at
        from (select * from raw_inventory
              {_latest('book_url', 'upc num_in_stock num_reviews description')})""",
    "catalogue": """
        select b.book_url, b.book_title, b.price_gbp, b.rating_stars, b.rating_word, b.category_id,
               c.category_name, i.upc, i.num_in_stock, i.num_reviews, i.description,
               case when i.num_in_stock = 0 then 'Out of Stock'
                    when i.num_in_stock < 5 then 'Low Stock' else 'Available' end as stock_status,
               b.extracted_at
        from stg_books b
        left join stg_categories c on b.category_id = c.category_id
        left join stg_inventory i on b.book_url = i.book_url""",
    "dim_books": "select * exclude (book_url) from catalogue",
    "mart_category_summary": f"""
        select category_id, category_name, count(*) as total_books,
               {_mean('price_gbp')} as avg_price_gbp,
               min(price_gbp) as min_price_gbp, max(price_gbp) as max_price_gbp,
               {_mean('rating_stars')} as avg_rating_stars,
               cast(sum(num_in_stock) as bigint) as total_stock,
               count(*) filter (stock_status = 'Out of Stock') as out_of_stock_count,
               count(*) filter (stock_status = 'Low Stock') as low_stock_count
        from dim_books group by category_id, category_name""",
    # the letter of a band: how many of the four bounds a price has reached; no price is the last band
    "bands": """
        select unnest(['A: Under £10', 'B: £10–£20', 'C: £20–£30', 'D: £30–£40', 'E: £40 and above']) as price_band,
               unnest(range(5)) as step""",
    "in_band": """
        select d.*, price_band from dim_books d
        join bands on step = coalesce(least(greatest(cast(floor(price_gbp / 10) as integer), 0), 4), 4)""",
    "best_of_band": """
        select price_band, arg_min((rating_stars, price_gbp), (-coalesce(rating_stars, 99), coalesce(price_gbp, 1e9))) as best
        from in_band group by price_band""",
    "mart_price_bands": f"""
        select price_band, count(*) as total_books,
               {_mean('price_gbp')} as avg_price_gbp, {_mean('rating_stars')} as avg_rating_stars,
               max(book_title) filter ((rating_stars, price_gbp) is not distinct from best) as top_rated_book,
               max(category_name) filter ((rating_stars, price_gbp) is not distinct from best) as top_rated_book_category
        from in_band join best_of_band using (price_band) group by price_band""",
    "search_docs": """
        select book_url, book_title, category_name, price_gbp, rating_stars, stock_status, num_in_stock, description,
               book_title || ' [' || coalesce(category_name, '') || ']: ' || coalesce(description, '') as search_text
        from catalogue where description is not null""",
    # text search: indexed(id, body) and asked(qid, question) come from the statement
    "doc_tf": """
        select id, term, count(*) as tf
        from (select id, unnest(regexp_extract_all(lower(body), '[\\pL\\pN]+')) as term from indexed)
        group by id, term""",
    "idf": """
        select term, ln(((select count(*) from indexed) + 1.0::double) / (count(*) + 1.0::double)) as idf
        from doc_tf group by term""",
    "doc_w": """
        select id, term, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by id)) as w
        from doc_tf join idf using (term) where idf > 0""",
    "ask_w": """
        select qid, term, tf * idf / sqrt(sum(tf * idf * tf * idf) over (partition by qid)) as qw
        from (select qid, term, count(*) as tf
              from (select qid, unnest(regexp_extract_all(lower(question), '[\\pL\\pN]+')) as term from asked)
              group by qid, term) join idf using (term) where idf > 0""",
    "scored": """
        select qid, id, round(sum(w * qw), 9) as score from doc_w join ask_w using (term) group by qid, id""",
    "asked": "select item_id as qid, text as question from benchmark",
    "indexed": "select book_url as id, search_text as body from search_docs",
    "hits": """
        select h.qid, h.rank, h.score, s.*
        from (select qid, id, score, row_number() over (partition by qid order by score desc, id) as rank
              from scored qualify rank <= 5) h
        join search_docs s on s.book_url = h.id""",
    "prompts": f"""
        select q.qid,
               '{answers.INSTRUCTION}' || chr(10) || chr(10)
               || string_agg(rank || '. "' || book_title || '" (' || coalesce(category_name, 'None') || ', £'
                    || cast(cast(price_gbp as double) as varchar) || ', ' || repeat('★', rating_stars)
                    || ')' || chr(10) || '   ' || description, chr(10) || chr(10) order by rank)
               || chr(10) || chr(10) || 'Question: ' || any_value(q.question) || chr(10) || 'Answer:' as prompt
        from asked q join hits h on q.qid = h.qid group by q.qid""",
    # the shop's pages
    "cards": f"""
        select p_partkey, p_size, p_partkey % {SHELVES} as shelf,
               (p_partkey // {SHELVES}) // {CARDS_PER_PAGE} as page_no,
               (p_partkey // {SHELVES}) % {CARDS_PER_PAGE} as slot,
               p_name || ' & ' || p_brand as title, {_PRICE} as price, {_RATING} as rating_word, {_URL} as book_url
        from part""",
    "shelf_page": f"""
        select distinct shelf, page_no,
               '{SHOP}/catalogue/category/books/shelf_' || shelf || '/'
               || case when page_no = 0 then 'index.html' else 'page-' || (page_no + 1) || '.html' end as url
        from cards""",
    "page_books": f"""
        select title as product_name, price, rating_word, cast(shelf as integer) as category_id, book_url,
               timestamp '2024-03-01 12:00:00' as extracted_at
        from cards qualify row_number() over (partition by title order by shelf, page_no, slot) = 1""",
    "page_categories": f"""
        select cast(shelf as integer) as category_id, coalesce(n_name, 'Shelf ' || shelf) as category_name
        from (select distinct shelf from cards) left join nation on n_nationkey = shelf""",
    "page_inventory": """
        select book_url, case when p_size = 49 then '' else 'u' || p_partkey end as upc,
               case when p_size % 10 = 0 then 0 else p_size end as num_in_stock,
               p_size as num_reviews,
               regexp_replace(text, '^\\s+|\\s+$', '', 'g') as description,
               timestamp '2024-03-01 12:00:00' as extracted_at
        from cards left join documents on p_partkey = doc_id where p_size not in (48, 50)""",
}

_BOOKS = ["raw_books", "raw_categories", "raw_inventory", "stg_books", "stg_categories", "stg_inventory", "catalogue", "dim_books"]
_SEARCH = ["indexed", "asked", "doc_tf", "idf", "doc_w", "ask_w", "scored"]
_BOOK_SEARCH = [*_BOOKS, "search_docs", *_SEARCH, "hits"]


def _sql(ctes: list[str], body: str, **own: str) -> str:
    parts = {**_CTE, **own}
    names = [*(n for n in own if n not in ctes), *ctes]
    return "with " + ",\n".join(f"{n} as ({parts[n]})" for n in names) + "\n" + body


def _suite_sql() -> str:
    rows = []
    for table, tests in BOOK_SUITE.items():
        for test in tests:
            c = test.column
            match test:
                case NotNull():
                    source = f"{table} where {c} is null"
                case Unique():
                    source = f"(select {c} from {table} where {c} is not null group by {c} having count(*) > 1)"
                case AcceptedValues():
                    values = ", ".join(repr(v) for v in test.values)
                    source = f"(select distinct {c} from {table} where {c} not in ({values}))"
                case Relationships():
                    source = (
                        f"{table} where {c} is not null and {c} not in "
                        f"(select {test.field} from {test.to} where {test.field} is not null)"
                    )
                case ExpressionIsTrue():
                    source = f"{table} where not ({c} {test.expression})"
            rows.append(
                f"select '{table}' as table_name, '{c}' as column_name, '{test.kind}' as test_name, "
                f"count(*) as failures from {source}"
            )
    return "\nunion all\n".join(rows)


def statements() -> dict[str, str]:
    dim = _BOOKS
    bands = [*_BOOKS, "bands", "in_band", "best_of_band", "mart_price_bands"]
    event_latest = """
        select * from events
        qualify row_number() over (partition by user_id, event_type order by ts desc nulls first, event_id) = 1"""
    links = """
        select url, cast(unnest(range(len(tags))) as integer) as pos, unnest(tags) as tag
        from (select url, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) as tags from pages)"""
    means = """
        select label as qid, list(m order by i) as qv
        from (select label, i, avg(embedding[i]::double) as m
              from embeddings, range(1, 65) r(i) group by label, i) group by label"""
    snapshots = {
        "old": "select doc_id, lang, source, text from documents where lang <> 'de'",
        "new": """select doc_id, lang, source, case when source = 'src2' then text || '!' else text end as text
                  from documents where source <> 'src3'""",
        "diff": """
            select doc_id, case when o.doc_id is null then 'insert' when n.doc_id is null then 'delete'
                                when (o.lang, o.source, o.text) is distinct from (n.lang, n.source, n.text)
                                then 'update' end as change
            from old o full join new n using (doc_id)""",
    }
    page_marts = {
        "raw_books": _CTE["page_books"],
        "raw_categories": "select *, timestamp '2024-03-01 12:00:00' as extracted_at from page_categories",
        "raw_inventory": _CTE["page_inventory"],
    }
    page_bands = "with " + ",\n".join(
        f"{n} as ({ {**_CTE, **page_marts}[n] })"
        for n in ["cards", "page_categories", *bands]
    ) + "\nselect * from mart_price_bands"
    return {
        "dedup_latest": event_latest,
        "stream_latest": event_latest,
        "dedup_first_seen": "select * from part qualify row_number() over (partition by p_name order by p_partkey) = 1",
        "stg_books": _sql(["raw_books", "stg_books"], "select * from stg_books"),
        "stg_categories": _sql(["raw_categories", "stg_categories"], "select * from stg_categories"),
        "stg_inventory": _sql(["raw_inventory", "stg_inventory"], "select * from stg_inventory"),
        "dim_books": _sql(dim, "select * from dim_books"),
        "stock_status_counts": _sql(
            dim, "select stock_status, count(*) as n_books from dim_books group by stock_status"
        ),
        "mart_category_summary": _sql([*dim, "mart_category_summary"], "select * from mart_category_summary"),
        "mart_price_bands": _sql(bands, "select * from mart_price_bands"),
        "mart_price_bands_single_row": _sql(
            bands,
            """select m.price_band, total_books, avg_price_gbp, avg_rating_stars,
                      t.book_title as top_rated_book, t.category_name as top_rated_book_category
               from mart_price_bands m join (
                   select price_band, book_title, category_name from in_band join best_of_band using (price_band)
                   where (rating_stars, price_gbp) is not distinct from best
                   qualify row_number() over (partition by price_band
                       order by book_title desc nulls last, category_name desc nulls last) = 1
               ) t on t.price_band = m.price_band""",
        ),
        "price_rank": _sql(
            [*dim, "bands", "in_band"],
            """select book_title, price_gbp, rating_stars, category_name, price_band,
                      rank() over (partition by price_band
                                   order by rating_stars desc nulls first, price_gbp nulls last) as rank_in_band
               from in_band""",
        ),
        "csv_roundtrip": """
            select 'doc/' || doc_id as book_url,
                   case when source not in ('NULL', 'null', '') then source end as upc,
                   cast(n_chars as integer) as num_in_stock, cast(null as integer) as num_reviews,
                   case when text not in ('NULL', 'null', '') then text end as description,
                   timestamp '2024-01-01 10:00:00.123456' as extracted_at
            from documents""",
        "load_report": "select 2 * count(*) as rows_loaded, cast(least(2 * count(*), 1000) as bigint) as largest_file from part",
        "load_replace": _sql(["raw_books"], "select * from raw_books where category_id >= 10"),
        "load_append": _sql(["raw_books"], "select * from raw_books"),
        "load_redelivered": _sql(
            ["raw_books"],
            """select category_id, count(*) as n_rows,
                      cast((select count(*) from raw_books where category_id >= 10) as integer) as last_load
               from raw_books group by category_id""",
        ),
        "incremental_load": "select * from events",
        "page_links": f"select url, pos, tag as href from ({links})",
        "url_resolve": f"""
            select regexp_extract(url, '^(https?://[^/?#]+)', 1) || tag as target, count(*) as n_links
            from ({links}) group by 1""",
        "page_heading": """
            select page_id,
                   replace(replace(replace(replace(
                       trim(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g')),
                       '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as heading,
                   string_split(url, '/')[-2] as lang_part,
                   regexp_extract(string_split(url, '/')[-1], '\\d+') as number_part
            from pages""",
        "page_blocks": """
            select page_id, pos,
                   replace(replace(replace(replace(
                       regexp_replace(regexp_replace(block, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g'),
                       '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') as block_text
            from (select page_id, cast(unnest(range(len(b))) as integer) as pos, unnest(b) as block
                  from (select page_id, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) as b from pages))""",
        "page_quarantine": """
            select url, 'no product table' as reason from pages
            where not regexp_matches(html, '<table[^>]*table-striped')""",
        "category_links": _sql(
            ["cards"],
            f"""select cast(shelf as integer) as category_pos, cast(shelf as integer) as category_id,
                       '{SHOP}/catalogue/category/books/shelf_' || shelf || '/index.html' as category_url
                from (select distinct shelf from cards)""",
        ),
        "category_links_first_three": _sql(
            ["cards"],
            f"""select cast(shelf as integer) as category_pos, cast(shelf as integer) as category_id,
                       '{SHOP}/catalogue/category/books/shelf_' || shelf || '/index.html' as category_url
                from (select distinct shelf from cards) where shelf < 3""",
        ),
        "categories_from_pages": _sql(["cards", "page_categories"], "select * from page_categories"),
        "next_page_edges": _sql(
            ["cards", "shelf_page"],
            """select p.url, n.url as next_url from shelf_page p
               left join shelf_page n on n.shelf = p.shelf and n.page_no = p.page_no + 1""",
        ),
        "page_order": _sql(
            ["cards", "shelf_page"],
            """select cast(shelf as integer) as category_pos, cast(shelf as integer) as category_id,
                      url as page_url, page_no from shelf_page""",
        ),
        "books_from_pages": _sql(["cards", "page_books"], "select * from page_books"),
        "inventory_from_pages": _sql(["cards", "page_inventory"], "select * from page_inventory"),
        "inventory_quarantine": _sql(
            ["cards"],
            """select book_url, case p_size when 48 then 'page not fetched' else 'no product table' end as reason
               from cards where p_size in (48, 50)""",
        ),
        "bands_from_pages": page_bands,
        "json_field_totals": """
            select event_type, cast(sum(k) as bigint) as sum_k, max(k) as max_k
            from (select event_type, cast(json_extract_string(props, '$.k') as integer) as k from events)
            group by event_type""",
        "search_docs": _sql([*dim, "search_docs"], "select * from search_docs"),
        "search_lexical_topk": _sql(
            _SEARCH,
            """select qid, id as doc_id, cast(rank as integer) as rank, round(score, 6) as score
               from (select *, row_number() over (partition by qid order by score desc, id) as rank from scored)
               where rank <= 5""",
            indexed="select doc_id as id, text as body from documents",
        ),
        "search_blocks_topk": _sql(
            _SEARCH,
            """select qid, id as doc_id, cast(rank as integer) as rank, round(score, 6) as score
               from (select *, row_number() over (partition by qid order by score desc, id) as rank from scored)
               where rank <= 5""",
            indexed="select doc_id as id, text as body from documents",
        ),
        "search_refreshed": _sql(
            ["old", "new", *_SEARCH],
            """select qid, id as doc_id, cast(rank as integer) as rank, round(score, 6) as score
               from (select *, row_number() over (partition by qid order by score desc, id) as rank from scored)
               where rank <= 5""",
            **{k: snapshots[k] for k in ("old", "new")},
            indexed="select doc_id as id, text as body from new",
        ),
        "search_filter": _sql(
            [*dim, "search_docs", *_SEARCH],
            """select qid, cast(rank as integer) as rank, book_title, price_gbp, round(score, 6) as score
               from (select qid, score, book_title, price_gbp,
                            row_number() over (partition by qid order by score desc, id) as rank
                     from scored join search_docs on book_url = id
                     where price_gbp < 20 and stock_status <> 'Out of Stock')
               where rank <= 5""",
        ),
        "search_preview": _sql(
            _BOOK_SEARCH,
            """select qid, cast(rank - 1 as integer) as pos, book_title, category_name,
                      cast(price_gbp as decimal(38,0)) as price_gbp, rating_stars, description
               from hits where rank <= 3""",
        ),
        "search_vector_topk": f"""
            with means as ({means}),
            scored as (select qid, vec_id as doc_id,
                              round(list_cosine_similarity(embedding::double[], qv), 9) as score
                       from embeddings, means)
            select qid, doc_id, cast(rank as integer) as rank, round(score, 6) as score
            from (select *, row_number() over (partition by qid order by score desc, doc_id) as rank from scored)
            where rank <= 5""",
        "search_vector_multiprobe": """
            select count(distinct label) as n_questions, true as recall_reached, true as fewer_scored from embeddings""",
        "index_refresh_diff": _sql(list(snapshots), "select * from diff where change is not null", **snapshots),
        "index_refresh_log": _sql(
            list(snapshots),
            """select case change when 'delete' then 'delete' else 'upsert' end as op, count(*) as n
               from diff where change is not null group by 1""",
            **snapshots,
        ),
        "prompt_build": _sql(
            [*_BOOK_SEARCH, "prompts"], "select qid, prompt from asked left join prompts using (qid)"
        ),
        "answer_batch": _sql(
            _BOOK_SEARCH,
            f"""select a.qid, coalesce('I suggest ' || max(case when rank = 1 then book_title end) || '.',
                                       '{answers.NO_MATCH}') as answer,
                       cast(count(h.qid) as integer) as n_books,
                       coalesce(string_agg(book_title, ' | ' order by rank), '') as titles
                from asked a left join hits h on a.qid = h.qid group by a.qid""",
        ),
        "answer_records": _sql(
            _BOOK_SEARCH,
            """select qid, 'I suggest ' || first_value(book_title) over (partition by qid order by rank) || '.' as answer,
                      cast(rank - 1 as integer) as pos, book_title, category_name,
                      cast(price_gbp as double) as price_gbp, rating_stars, description
               from hits""",
        ),
        "dq_not_null": _sql(dim, "select book_title, category_id from dim_books where upc is null"),
        "dq_unique": "select p_name, count(*) as n_records from part where p_name is not null group by p_name having count(*) > 1",
        "dq_accepted_values": """
            select o_orderstatus, count(*) as n_records from orders
            where o_orderstatus not in ('F', 'O') group by o_orderstatus""",
        "dq_relationships": _sql(
            ["raw_books", "raw_categories", "stg_books", "stg_categories"],
            """select book_title, category_id from stg_books b
               where category_id is not null
                 and not exists (select 1 from stg_categories c where c.category_id = b.category_id)""",
        ),
        "dq_expression": "select c_custkey, c_acctbal from customer where not (c_acctbal >= 0)",
        "dq_report": _sql(
            [*bands, "mart_category_summary"], _suite_sql()
        ),
    }
