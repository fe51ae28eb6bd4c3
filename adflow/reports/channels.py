"""Report specs by channel. Output names are those of the stored tables."""

from __future__ import annotations

from adflow.functions.recode import (
    ASSET_FIELD_TYPE,
    ASSET_TYPE,
    NETWORK_TYPE,
    PERFORMANCE_LEVEL,
    SEGMENT_DEVICE,
)
from adflow.reports.engine import (
    Actions,
    Currency,
    First,
    Label,
    Marked,
    Projection,
    ReportSpec,
    VideoUrl,
)

AD = "ad_group_ad.ad"
DAY = "segments.date"


def _metrics(prefix: str, **names: str) -> dict[str, str]:
    return {f"{prefix}{out}": f"metrics.{path}" for out, path in names.items()}


IDS = {
    "campaignId": "campaign.id",
    "campaignName": "campaign.name",
    "adgroupId": "ad_group.id",
    "adgroupName": "ad_group.name",
}
IDS_CAPITAL = {
    "campaignID": "campaign.id",
    "campaignName": "campaign.name",
    "adgroupID": "ad_group.id",
    "adgroupName": "ad_group.name",
}
PERFORMANCE = {
    "costMicros": "metrics.cost_micros",
    "clicks": "metrics.clicks",
    "impressions": "metrics.impressions",
    "conversions": "metrics.conversions",
}
PLAIN_FACT = {
    "date": "segmentDate", "campaign": "campaignId", "adgroup": "adgroupId",
    "impressions": "impressions", "clicks": "clicks", "cost": "costMicros",
    "conversions": "conversions",
}

GOOGLE_AD = ReportSpec(
    name="google_ad",
    date=DAY,
    fields={
        "networkType": "segments.ad_network_type",
        "segmentsDate": DAY,
        "campaignId": "campaign.id",
        "campaignName": "campaign.name",
        "campaignAdvertisingChannelType": "campaign.advertising_channel_type",
        "campaignAdvertisingChannelSubType": "campaign.advertising_channel_sub_type",
        "adgroupId": "ad_group.id",
        "adgroupName": "ad_group.name",
        "adId": f"{AD}.id",
        "adName": f"{AD}.name",
        **_metrics(
            "metrics",
            Impressions="impressions", CostMicros="cost_micros", Clicks="clicks",
            Interactions="interactions", Ctr="ctr",
            ViewThroughConversions="view_through_conversions", Conversions="conversions",
            ConversionsFromInteractionRate="conversions_from_interactions_rate",
            CostPerConversions="cost_per_conversion", AllConversions="all_conversions",
            AllConversionsFromInteractionRate="all_conversions_from_interactions_rate",
            CostPerAllConversions="cost_per_all_conversions",
            VideoQuartileP100Rate="video_quartile_p100_rate",
            VideoQuartileP25Rate="video_quartile_p25_rate",
            VideoQuartileP50Rate="video_quartile_p50_rate",
            VideoQuartileP75Rate="video_quartile_p75_rate",
            VideoViews="video_views", VideoViewRate="video_view_rate",
        ),
    },
    cost="micros",
    fact={
        "date": "segmentsDate", "campaign": "campaignId", "adgroup": "adgroupId", "ad": "adId",
        "impressions": "metricsImpressions", "clicks": "metricsClicks",
        "cost": "metricsCostMicros", "conversions": "metricsConversions",
    },
)

GOOGLE_KEYWORD = ReportSpec(
    name="google_keyword",
    date=DAY,
    window="three_weeks",
    fields={
        **IDS,
        "keyword": "ad_group_criterion.keyword.text",
        **PERFORMANCE,
        "segmentDate": DAY,
        "segmentDevice": "segments.device",
    },
    cost="micros",
    fact=PLAIN_FACT,
)

GOOGLE_SEARCH_TERM = ReportSpec(
    name="google_search_term",
    date=DAY,
    fields={
        **IDS,
        "costMicros": "metrics.cost_micros",
        "clicks": "metrics.clicks",
        "impressions": "metrics.impressions",
        "segmentDate": DAY,
        "segmentDevice": Label("segments.device", SEGMENT_DEVICE),
        "segmentsKeywordInfoText": "segments.keyword.info.text",
        "searchTerm": "search_term_view.search_term",
    },
    distinct=True,
)

GOOGLE_CONVERSION_TYPE = ReportSpec(
    name="google_conversion_type",
    date=DAY,
    fields={
        **IDS,
        "conversionActionName": "segments.conversion_action_name",
        "segmentDate": DAY,
        "segmentDevice": Label("segments.device", SEGMENT_DEVICE),
        "segmentsKeywordInfoText": "segments.keyword.info.text",
        "searchTerm": "search_term_view.search_term",
        "metricsAllConversions": "metrics.all_conversions",
    },
    equal={"segments.conversion_action_name": ("purchase", "signup")},
    distinct=True,
)

GOOGLE_ADGROUP = ReportSpec(
    name="google_adgroup",
    date=DAY,
    positive="metrics.cost_micros",
    fields={
        "metricAllConversionsValue": "metrics.all_conversions_value",
        "metricAllConversions": "metrics.all_conversions",
        **_metrics(
            "metrics",
            CostPerAllConversions="cost_per_all_conversions",
            CostPerConversion="cost_per_conversion", ConversionsValue="conversions_value",
            Clicks="clicks", Conversions="conversions",
            CrossDeviceConversions="cross_device_conversions", Impressions="impressions",
            Interactions="interactions", ValuePerConversion="value_per_conversion",
            VideoView="video_views",
        ),
        "metricsCostMicors": Currency("metrics.cost_micros"),
        "segmentsAdNetworkType": "segments.ad_network_type",
        "segmentsDate": DAY,
        "segmentsDevice": "segments.device",
        **IDS_CAPITAL,
        "adgroupStatus": "ad_group.status",
        "adgroupType": "ad_group.type_",
    },
)

GOOGLE_ASSET = ReportSpec(
    name="google_asset",
    date=DAY,
    equal={"ad_group_ad_asset_view.enabled": (True,)},
    fields={
        "segmentsDate": DAY,
        **IDS_CAPITAL,
        "assetID": "asset.id",
        "assetName": "asset.name",
        "assetType": Label("asset.type_", ASSET_TYPE),
        "assetFieldType": Label("ad_group_ad_asset_view.field_type", ASSET_FIELD_TYPE),
        "assetText": "asset.text_asset.text",
        "assetImageFullSizeURL": "asset.image_asset.full_size.url",
        "assetYoutubeTitle": "asset.youtube_video_asset.youtube_video_title",
        "assetYoutubeVideoURL": VideoUrl("asset.type_", "asset.youtube_video_asset.youtube_video_id"),
        "assetYoutubeVideoID": "asset.youtube_video_asset.youtube_video_id",
        "assetPerformanceLevel": Label("ad_group_ad_asset_view.performance_label", PERFORMANCE_LEVEL),
        **_metrics(
            "metrics",
            AllConversionValue="all_conversions_value", Conversions="conversions",
            Clicks="clicks", CTR="ctr", Impressions="impressions",
        ),
        "metricsCostMicors": Currency("metrics.cost_micros"),
        "segmentsAdNetworkType": "segments.ad_network_type",
    },
)

GOOGLE_INSTALL_ADGROUP = ReportSpec(
    name="google_install_adgroup",
    date=DAY,
    fields={
        "segmentsDate": DAY,
        **IDS_CAPITAL,
        "adgroupStatus": "ad_group.status",
        "campaignAdvertisingChannelSubType": "campaign.advertising_channel_sub_type",
        "metricsCostMicros": "metrics.cost_micros",
        "metricsImpressions": "metrics.impressions",
        "segmentsAdNetworkType": "segments.ad_network_type",
        "segmentsAdNetworkTypeName": Label("segments.ad_network_type", NETWORK_TYPE),
    },
)
GOOGLE_INSTALLS = ReportSpec(
    name="google_installs",
    date=DAY,
    equal={"ad_group_ad_asset_view.enabled": (True,)},
    fields={
        "metricsInstallConversions": "metrics.biddable_app_install_conversions",
        "segmentsAdNetworkType": "segments.ad_network_type",
        "segmentsDate": DAY,
        "campaignID": "campaign.id",
        "adgroupID": "ad_group.id",
    },
)
INSTALL_KEYS = ("campaignID", "adgroupID", "segmentsAdNetworkType", "segmentsDate")

GOOGLE_AD_ASSET = ReportSpec(
    name="google_ad_asset",
    date=DAY,
    fields={
        **IDS, "adId": f"{AD}.id", "adName": f"{AD}.name",
        "assetId": "asset.id", "assetName": "asset.name", **PERFORMANCE, "segmentDate": DAY,
    },
)

GOOGLE_MARKED_AD = ReportSpec(
    name="google_marked_ad",
    date=DAY,
    fields={
        **IDS, "adId": f"{AD}.id", "adName": f"{AD}.name",
        "assetName": Marked(f"{AD}.final_urls"), **PERFORMANCE, "segmentDate": DAY,
    },
    cost="micros",
    fact={**PLAIN_FACT, "ad": "adId"},
)

GOOGLE_KEYWORD_VIEW = ReportSpec(
    name="google_keyword_view",
    date=DAY,
    fields={
        **IDS,
        "keywordId": "ad_group_criterion.criterion_id",
        "keywordName": "ad_group_criterion.keyword.text",
        "keywordMatchType": "ad_group_criterion.keyword.match_type",
        **PERFORMANCE,
        "ctr": "metrics.ctr",
        "segmentDate": DAY,
    },
)

GOOGLE_CAMPAIGN = ReportSpec(
    name="google_campaign",
    date=DAY,
    fields={
        "segmentsDate": DAY,
        "campaignID": "campaign.id",
        "campaignName": "campaign.name",
        "campaignAdvertisingChannelType": "campaign.advertising_channel_type",
        "campaignOptimizationScore": "campaign.optimization_score",
        **_metrics(
            "metrics",
            AverageCPV="average_cpv", AverageCPM="average_cpm", AverageCPE="average_cpe",
            AverageCPC="average_cpc", AverageCost="average_cost", Clicks="clicks",
            Conversions="conversions", CostPerConversion="cost_per_conversion",
            Interactions="interactions", InteractionRate="interaction_rate",
            Impressions="impressions", CTR="ctr", CostMicors="cost_micros",
            ActiveViewCTR="active_view_ctr", ActiveViewCPM="active_view_cpm",
            ActiveViewImpressions="active_view_impressions",
            ConversionFromInteractionsRate="conversions_from_interactions_rate",
        ),
    },
)

GOOGLE_AD_VIEWABILITY = ReportSpec(
    name="google_ad_viewability",
    date=DAY,
    fields={
        **IDS,
        "averageCost": "metrics.average_cost",
        "clicks": "metrics.clicks",
        "conversions": "metrics.conversions",
        "impressions": "metrics.impressions",
        "ctr": "metrics.ctr",
        "activeViewViewability": "metrics.active_view_viewability",
        "adId": f"{AD}.id",
        "adName": f"{AD}.resource_name",
        "segmentDate": DAY,
    },
)

GOOGLE_RESPONSIVE = ReportSpec(
    name="google_responsive",
    date=DAY,
    window="three_weeks",
    fields={
        **IDS,
        "adId": f"{AD}.id",
        "adName": f"{AD}.responsive_display_ad.long_headline.text",
        "adDescriptions": First(f"{AD}.responsive_display_ad.descriptions", "text"),
        **PERFORMANCE,
        "segmentDate": DAY,
        "segmentDevice": "segments.device",
    },
)

GOOGLE_IMPRESSION_SHARE = ReportSpec(
    name="google_impression_share",
    date=DAY,
    fields={
        **IDS,
        "keyword": "ad_group_criterion.keyword.text",
        "costMicros": "metrics.cost_micros",
        "clicks": "metrics.clicks",
        "impressions": "metrics.impressions",
        "searchImpressionShare": "metrics.search_impression_share",
        "segmentDate": DAY,
    },
)

_ASSET_HISTORY = {
    "assetID": "asset.id",
    "assetName": "asset.name",
    "segmentsAdNetworkType": "segments.ad_network_type",
    "adgroupName": "ad_group.name",
    "metricConversions": "metrics.conversions",
    "metricConversionsValue": "metrics.conversions_value",
    "metricsAllConversionValue": "metrics.all_conversions_value",
    "metricsImpressions": "metrics.impressions",
    "metricsClicks": "metrics.clicks",
    "metricsCTR": "metrics.ctr",
    "segmentsDate": DAY,
    "campaignID": "campaign.id",
}
GOOGLE_ASSET_HISTORY = ReportSpec(
    name="google_asset_history",
    date=DAY,
    fields={**_ASSET_HISTORY, "assetType": Label("asset.type_", ASSET_TYPE)},
)
GOOGLE_ASSET_HISTORY_INSTALLS = ReportSpec(
    name="google_asset_history_installs",
    date=DAY,
    fields={
        **_ASSET_HISTORY,
        "assetType": "asset.type_",
        "metricsBiddableAppInstallConversion": "metrics.biddable_app_install_conversions",
        "metricsBiddableAppPostInstallConversion": "metrics.biddable_app_post_install_conversions",
    },
)

VIDEO_ACTIONS = {
    "videoP25WatchedActions": First("video_p25_watched_actions"),
    "videoP50WatchedActions": First("video_p50_watched_actions"),
    "videoP75WatchedActions": First("video_p75_watched_actions"),
    "videoP100WatchedActions": First("video_p100_watched_actions"),
    "videoPlayActions": First("video_play_actions"),
}
FACEBOOK_AD = ReportSpec(
    name="facebook_ad",
    date="date_start",
    fields={
        "adId": "ad_id", "adName": "ad_name", "adsetId": "adset_id", "adsetName": "adset_name",
        "campaignId": "campaign_id", "campaignName": "campaign_name",
        "dateStart": "date_start", "dateStop": "date_stop",
        "impressions": "impressions", "frequency": "frequency", "reach": "reach", "spend": "spend",
        **VIDEO_ACTIONS,
    },
    actions=(Actions("actions", ("link_click",)),),
    defaults=("impressions", "frequency", "reach", "spend", "linkClick", *VIDEO_ACTIONS),
    fact={
        "date": "dateStart", "campaign": "campaignId", "adgroup": "adsetId", "ad": "adId",
        "impressions": "impressions", "clicks": "linkClick", "cost": "spend",
    },
)
FACEBOOK_WASH_METRICS = (
    "dateStop", "frequency", "impressions", "linkClick", "reach", "spend", *VIDEO_ACTIONS,
)
FACEBOOK_KEYS = ("campaignId", "adsetId", "adId", "dateStart")
FACEBOOK_DESCRIPTORS = ("adName", "adsetName", "campaignName")

# Action types counted for app campaigns.
APP_ACTIONS = (
    "mobile_app_install", "omni_app_install", "post_engagement", "video_view",
    "landing_page_view", "app_install", "omni_activate_app", "link_click",
)
FACEBOOK_ACCOUNT = ReportSpec(
    name="facebook_account",
    date="date_start",
    fields={
        "accountId": "account_id", "dateStart": "date_start", "dateStop": "date_stop",
        "impressions": "impressions", "reach": "reach", "spend": "spend",
        "videoP100WatchedActions": VIDEO_ACTIONS["videoP100WatchedActions"],
        "videoPlayActions": VIDEO_ACTIONS["videoPlayActions"],
    },
    actions=(Actions("actions", APP_ACTIONS), Actions("unique_actions", APP_ACTIONS, "unique_")),
    defaults=("impressions", "reach", "spend", "videoP100WatchedActions", "videoPlayActions"),
)

CRITEO = ReportSpec(
    name="criteo",
    date="Day",
    window="two_days",
    fields={
        n: n for n in (
            "Ad", "Campaign", "Adset", "Device", "Channel", "Day", "Clicks", "Displays",
            "AdvertiserCost",
        )
    },
    fact={
        "date": "Day", "campaign": "Campaign", "adgroup": "Adset", "ad": "Ad",
        "impressions": "Displays", "clicks": "Clicks", "cost": "AdvertiserCost",
    },
)

# Metrics of the app attribution report, before camel case.
AIRBRIDGE_METRICS = (
    "impressions", "clicks", "impressions_channel", "clicks_channel", "cost_channel",
    "app_events", "app_event_value", "app_attributed_events", "app_installs",
    "app_first_installs", "app_re_installs", "app_attributed_installs",
    "app_unattributed_installs", "app_deferred_deeplink_installs", "app_uninstalls",
)

KAKAO_FACT = Projection("kakao", {
    "date": "start", "campaign": "campaignId", "adgroup": "adgroupId", "ad": "id",
    "clicks": "metricsClick", "cost": "metricsCostSum",
})
TWITTER_FACT = Projection("twitter", {
    "date": "segmentDate", "campaign": "campaignId", "adgroup": "lineItemId", "ad": "tweetId",
    "impressions": "metricsImpressions",
})
TWITTER_ORGANIC_FACT = Projection("twitterorganic", {
    "campaign": "campaignName", "ad": "tweetId", "impressions": "metricsImpressions",
    "cost": "metricsBilledChargeLocalMicro",
}, cost="micros")
AIRBRIDGE_FACT = Projection("airbridge", {
    "date": "eventDate", "campaign": "channel", "impressions": "impressions", "clicks": "clicks",
    "cost": "costChannel", "conversions": "appInstalls",
})

# Headers of the organic tweet sheets.
ORGANIC_HEADERS = {
    "기간": "segmentDate",
    "캠페인 이름": "campaignName",
    "광고 그룹 이름": "lineItemName",
    "트윗 ID": "tweetId",
    "광고 이름": "tweetName",
    "링크 클릭수": "metricsLinkClicks",
    "설치 횟수": "metricsAppInstalls",
    "비용": "metricsBilledChargeLocalMicro",
    "트윗 참여": "metricsEngagements",
    "노출수": "metricsImpressions",
    "동영상 25% 재생": "metricsVideoViews25",
    "동영상 50% 재생": "metricsVideoViews50",
    "동영상 75% 재생": "metricsVideoViews75",
    "동영상 재생 완료": "metricsVideoViews100",
    "동영상 조회": "metricsVideoTotalView",
    "앱 클릭수": "metricsAppClicks",
}
ORGANIC_MAPPING_HEADERS = {
    "최초 라이브": "createdAt",
    "Campaign name": "campaignName",
    "Creative name": "creativeName",
    "Tweet ID": "tweetId",
}
