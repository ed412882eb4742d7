"""Page predicates: noise pages, item pages, search areas, click areas."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vendue.functions.text import any_of, default_if_blank

# Fixed values of the shop's sites ------------------------------------------

# URLs that never count as the page before a cart
NOISE_URLS = [
    "item/itemDetailRate.ssg",
    "item/itemDetailDesc.ssg",
    "item/itemDetailQna.ssg",
    "item/itemDetailReturn.ssg",
    "item/itemDetailDescOrgView.ssg",
    "item/itemComment.ssg",
    "item/itemSimple.ssg",
    "item/itemViewSub.ssg",
    "item/itemQna.ssg",
    "item/itemQnaPageList.ssg",
    "item/itemImage.ssg",
    "item/itemCard.ssg",
    "item/appItemView.ssg",
    "item/appItemDescInfoView.ssg",
    "item/appItemLayer.ssg",
    "item/appItemPrcDtlView.ssg",
    "item/popup/popupCoupon.ssg",
    "item/popup/popupItemChnl.ssg",
    "item/popup/couponInfo.ssg",
    "item/popup/popupProductImg.ssg",
    "item/popup/popupMoreView.ssg",
    "item/popup/popupReserve.ssg",
    "/shipping/showPopupDelivery.ssg",
    "/event/couponInfo.ssg",
    "/event/firstbuyCpn.ssg",
    "/obanjang/popupObanjang.ssg",
    "/channel/popupHappyBuyrus.ssg",
    "/cart/dmsShpp.ssg",
    "/cart/perdcShpp.ssg",
    "/cart/getRplcItemList.ssg",
    "/order/ordPage.ssg",
    "/order/ocbCheckPop.ssg",
    "/order/popup.ssg",
    "/order/spointCheckPop.ssg",
    "/order/loadPaymtAuthPage.ssg",
    "/myssg/popup/popupMbrGrdCpn.ssg",
    "/myssg/moneyMng/memberCpnOwnList.ssg",
    "/myssg/cancelProcess.ssg",
    "/comm/app",
    "/comm/evnt/promBanr.ssg",
    "/comm/chnlPopup.ssg",
    "/appApi",
    "/comm/popup",
    "/comm/zipcd/loadPaymtPage.ssg",
    "/customer",
    "/nodcsnOrder/drctPurch.ssg",
    "/nodcsnOrder/ordShppInfo.ssg",
    "/item/pItemDtlDesc.ssg",
    "/item/popup/popupItemView.ssg",
    "member.",
]
NOISE_SCREENS = ["Login"]

# item-detail pages that are skipped when they lead straight to the cart
DETAIL_URLS = [
    "/itemView.ssg",
    "/itemView01.ssg",
    "/itemDtl.ssg",
    "/itemDetailRate.ssg",
    "/itemDetailDesc.ssg",
    "/dealItemView.ssg",
    "/item/itemSimple.ssg",
    "/quickItemView.ssg",
]
DETAIL_SCREENS = [
    "ItemDetail",
    "ProductDealNativeFragment",
    "DealViewController",
    "ProductDetailNativeFragment",
    "ItemDetailViewController",
]

# item pages that count as an item view in the click log
ITEM_VIEW_URLS = [
    "/itemSimple.ssg",
    "/itemView.ssg",
    "/itemView01.ssg",
    "/itemDtl.ssg",
    "/burberryItemView.ssg",
    "/gucciItemDtl.ssg",
]
ITEM_VIEW_SCREENS = ["ItemDetail"]

# pages left out before attribution
UNATTRIBUTED_URLS = ["/item/appItemLayer.ssg", "/item/appItemPrcDtlView.ssg", "/item/appItemInfoPopup.ssg"]

# search model: areas of the search result that lead to an item page (prefixes)
SEARCH_AREAS = [
    "검색결과|전체상품탭|특가딜영역_상품_클릭",
    "검색결과|전체상품탭|상품_클릭",
    "검색결과|테마검색탭|이슈테마레이어_상품클릭",
    "검색결과|도서취미검색결과|상품_클릭",
]
# search model: item pages by URL
MODEL_ITEM_URLS = [
    "burberryItemView.ssg",
    "chanelItemDetail.ssg",
    "dealItemView.ssg",
    "gucciItemDtl.ssg",
    "iframeBbrItemDtlDesc.ssg",
    "itemDtl.ssg",
    "itemList.ssg",
    "itemView.ssg",
    "itemView01.ssg",
    "macItemView.ssg",
]
# search model: native item screens (suffixes)
MODEL_ITEM_SCREENS = [
    "ItemDetail",
    "ItemDetailViewController",
    "DealViewController",
    "ProductDetailNativeFragment",
    "ProductDealNativeFragment",
]
# search model: search pages and search screens (suffixes)
SEARCH_URLS = ["search.ssg", "jsonSearch.ssg"]
SEARCH_SCREENS = ["SearchResult", "ProductListFragment", "NewSearchResultBaseViewController"]

# URL parameters that name the clicked area, with the prefix put before the value
AREA_PARAMS = {"tarea": "", "click": "", "CatForYou": "CatForYou_", "ForYouB": "ForYouB_"}

# site codes whose app pages carry a prefix
PAGE_PREFIXES = {
    "1": "SSG_",
    "2": "EM_",
    "3": "TR_",
    "4": "BM_",
    "5": "SM_",
    "6": "SD_",
    "7": "TV_",
    "8": "HD_",
    "10": "BT_",
    "11": "SIV_",
    "12": "STF_",
}

# ---------------------------------------------------------------------------


def _prefix(values: Sequence[str]) -> str:
    return f"^({any_of(values)})"


def _suffix(values: Sequence[str]) -> str:
    return f"({any_of(values)})$"


def is_noise(url: Column, screen: Column) -> Column:
    """Pages that never explain a cart."""
    return url.rlike(any_of(NOISE_URLS)) | screen.rlike(any_of(NOISE_SCREENS))


def is_detail(url: Column, screen: Column) -> Column:
    """Item-detail pages."""
    return url.rlike(any_of(DETAIL_URLS)) | screen.rlike(any_of(DETAIL_SCREENS))


def is_item_view(url: Column, screen: Column) -> Column:
    return url.rlike(any_of(ITEM_VIEW_URLS)) | screen.rlike(any_of(ITEM_VIEW_SCREENS))


# Named predicates of the search model; each takes the columns of a log frame.
PREDICATES: dict[str, Callable[[], Column]] = {
    "search_area": lambda: F.col("area").rlike(_prefix(SEARCH_AREAS)),
    "item_url": lambda: F.col("url").rlike(any_of(MODEL_ITEM_URLS)),
    "item_screen": lambda: F.col("screen_code").rlike(_suffix(MODEL_ITEM_SCREENS)),
    "search_url": lambda: F.col("url").rlike(any_of(SEARCH_URLS)),
    "search_screen": lambda: F.col("screen_code").rlike(_suffix(SEARCH_SCREENS)),
    "search_referrer": lambda: F.col("referrer").contains("search.ssg"),
}


def click_area(url: Column, params: Mapping[str, str] = AREA_PARAMS, lead: str = "&") -> Column:
    """First area parameter that has a value; null when there is none.

    ``lead`` is a pattern of what stands before a parameter. A value goes up to the
    next parameter, and with another lead than the default also to a fragment.
    """
    ends = "&" if lead == "&" else "&#"
    found = []
    for name, prefix in params.items():
        value = F.regexp_extract(url, f"{lead}{name}=([^{ends}]+)", 1)
        found.append(F.when(value != "", F.concat(F.lit(prefix), value)))
    return F.coalesce(*found)


def page_url(url: Column, screen: Column) -> Column:
    """Screen code where the URL is empty."""
    return default_if_blank(url, screen)


def page_code(site: Column, url: Column, device: Column, prefixes: Mapping[str, str] = PAGE_PREFIXES) -> Column:
    """App pages get the prefix of their site unless it is there; blanks at the end go."""
    bare = F.regexp_replace(url, r"\s+$", "")
    out = bare
    for code, prefix in prefixes.items():
        lacks = (site.cast("string") == code) & ~url.contains(prefix)
        out = F.when(lacks, F.concat(F.lit(prefix), bare)).otherwise(out)
    return F.when(device.contains("mobile app"), out).otherwise(bare)
